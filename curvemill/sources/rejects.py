"""Rows that do not parse: kept with their file, the raw record and a reason per column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvemill.sources.feeds import under_header
from curvemill.staging import stage

PROBLEMS = "problems"
NOT_CONVERTED, BROKEN = "not a {}", "the record has another number of columns"


@dataclass(frozen=True)
class Checked:
    """The rows that conform, and (file, record, problems) of those that do not."""

    good: DataFrame
    rejected: DataFrame


def convert(column: str, kind: str, date_format: str | None = None) -> Column:
    """A text column as another type; null where it does not convert."""
    if kind == "date" and date_format:
        return F.try_to_date(F.col(column), date_format)
    return F.col(column).try_cast(kind)


def checked_types(df: DataFrame, types: Mapping[str, str], date_format: str | None = None) -> DataFrame:
    """The listed columns converted, and ``problems``: (column, value, reason) of those that fail.

    A null is no problem. A row with a problem keeps the columns that did convert.
    """
    made = {c: convert(c, kind, date_format) for c, kind in types.items()}
    problems = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & made[c].isNull(), F.struct(
            F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
            F.lit(NOT_CONVERTED.format(kind)).alias("reason"))) for c, kind in types.items()]))
    return df.select("*", problems.alias(PROBLEMS)).withColumns(made)


def read_checked(spark: SparkSession, folder: str, schema: str, pattern: str | None = None,
                 delimiter: str = ",", header: bool = True, date_format: str = "yyyy-MM-dd",
                 positional: bool = False) -> Checked:
    """Delimited files under a schema, without losing what does not fit it.

    Every record of the files is either a good row or a rejected one. All columns are read as
    text first; a record with too few or too many columns comes with its raw line, one with
    values that do not convert is written anew from its columns. The files are read once and the
    checked rows staged, so both results come from the same table.
    """
    declared = T.StructType.fromDDL(schema)
    reader, found = under_header(spark.read.option("sep", delimiter), folder, declared, pattern, header,
                                 positional)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in found])
    rows = reader.option("columnNameOfCorruptRecord", "_raw").schema(texts.add("_raw", "string")) \
        .csv(folder).select("*", F.col("_metadata.file_path").alias("_file"))
    line = F.to_csv(F.struct(*texts.names[:-1]), {"sep": delimiter})
    rows = rows.withColumn("_record", F.coalesce("_raw", line))
    checked = checked_types(rows, {f.name: f.dataType.simpleString() for f in declared}, date_format)
    broken = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.col("_raw").alias("value"),
                              F.lit(BROKEN).alias("reason")))
    checked = stage(checked.withColumn(
        PROBLEMS, F.when(F.col("_raw").isNotNull(), broken).otherwise(F.col(PROBLEMS))), "checked").df
    bad = F.size(PROBLEMS) > 0
    return Checked(checked.where(~bad).select(*declared.names), checked.where(bad).select(
        F.col("_file").alias("file"), F.col("_record").alias("record"), PROBLEMS))
