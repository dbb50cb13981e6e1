"""Feeds: delimited files, databases, pulls by watermark and small dimensions."""

from __future__ import annotations

from datetime import timezone

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curvemill.functions.calendar import refresh_due
from curvemill.sources.sinks import write_table
from curvemill.sources.snapshots import WATERMARK, read_table

# Smallest value per watermark type: everything is newer than an empty target.
LOWEST = {
    "date": "DATE'0001-01-01'",
    "timestamp": "TIMESTAMP'0001-01-01 00:00:00'",
    "timestamp_ntz": "TIMESTAMP_NTZ'0001-01-01 00:00:00'",
    "int": "-2147483648",
    "bigint": "-9223372036854775807L - 1L",
    "double": "double('-Infinity')",
    "string": "''",
}


def read_delimited(spark: SparkSession, folder: str, schema: str, pattern: str | None = None,
                   delimiter: str = ",", header: bool = True, date_format: str = "yyyy-MM-dd",
                   positional: bool = False) -> DataFrame:
    """Delimited files of a folder whose names match ``pattern``, under a declared schema.

    A declared schema reads the files once; inference would read them twice. Under a header the
    columns are found by name, in any order and case, and a file whose header differs from the
    first one's fails. Other names in the header fail as well, unless ``positional`` says that
    the columns are meant by their position. The result has the names and order of the schema.
    """
    reader = spark.read.option("sep", delimiter).option("dateFormat", date_format)
    reader, found = under_header(reader, folder, T.StructType.fromDDL(schema), pattern, header, positional)
    return reader.schema(found).csv(folder).select(*T.StructType.fromDDL(schema).names)


def under_header(reader: DataFrameReader, folder: str, schema: T.StructType, pattern: str | None,
                 header: bool, positional: bool) -> tuple[DataFrameReader, T.StructType]:
    """The reader with its options, and the fields of ``schema`` in the order of the files."""
    reader = reader.option("header", header)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if not header or positional:
        return reader, schema
    names = [c.strip().lower() for c in reader.csv(folder).columns]
    declared = [f.name.lower() for f in schema]
    if sorted(names) != sorted(declared):
        raise ValueError(f"The header has {names}, the schema {declared}")
    return reader.option("enforceSchema", False), T.StructType(
        [schema.fields[declared.index(n)] for n in names])


def read_database(spark: SparkSession, url: str, table: str, *, split_by: str | None = None,
                  bounds: tuple | None = None, splits: int = 1,
                  properties: dict[str, str] | None = None) -> DataFrame:
    """A database table; ``split_by`` with its bounds reads it in parallel ranges."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if split_by:
        low, high = bounds
        reader = reader.options(partitionColumn=split_by, lowerBound=str(low),
                                upperBound=str(high), numPartitions=str(splits))
    return reader.load()


def incremental_rows(source: DataFrame, target: DataFrame, watermark: str,
                     target_watermark: str | None = None) -> DataFrame:
    """Source rows newer than everything in the target; all rows for an empty target.

    The limit is a scalar subquery, so a Parquet source gets it as a pushed filter.
    """
    kind = target.select(target_watermark or watermark).dtypes[0][1]
    if kind not in LOWEST:
        raise ValueError(f"A {kind} column cannot serve as watermark")
    newest = target.agg(F.coalesce(F.max(target_watermark or watermark),
                                   F.expr(LOWEST[kind]))).scalar()
    return source.where(F.col(watermark) > newest)


def active_dimension(rows: DataFrame, lookup: DataFrame, on: Column,
                     active: list[Column], required: list[str]) -> DataFrame:
    """Inner join of two dimensions, reduced to active rows with the required codes.

    Sizes come from the tables, so Spark broadcasts the lookup only if it is small.
    """
    joined = rows.join(lookup, on)
    for condition in active:
        joined = joined.where(condition)
    return joined.dropna(subset=required)


def newest_stamp(target: DataFrame, watermark: str):
    """Greatest watermark of a table on the driver; None for an empty table.

    A timestamp comes with its zone, so that it means the same moment as a literal.
    """
    newest = target.agg(F.max(watermark).alias("newest"))
    stamp = newest.first()[0]
    if stamp is not None and isinstance(newest.schema["newest"].dataType, T.TimestampType):
        return stamp.astimezone(timezone.utc)
    return stamp


def rows_since(source: DataFrame, watermark: str, stamp) -> DataFrame:
    """Source rows newer than a known stamp; all rows without one.

    For sources that cannot take a subquery: a database gets the stamp as a literal in
    its own WHERE clause and sends the new rows only.
    """
    newer = F.col(watermark).isNotNull() if stamp is None else F.col(watermark) > F.lit(stamp)
    return source.where(newer)


def append_newer(source: DataFrame, target: str, watermark: str,
                 partition_by: str | None = None) -> None:
    """Append the source rows that are newer than everything in the target table.

    The target must exist. Its newest stamp is read first and goes to the source as a literal,
    so a database or a Parquet source sends the new rows only. One job writes them, whose
    commit makes them visible together: a repeated run after a failure adds nothing twice.
    """
    stamp = newest_stamp(read_table(source.sparkSession, target), watermark)
    write_table(rows_since(source, watermark, stamp), target, partition_by=partition_by)


def rows_if_due(source: DataFrame, loaded: DataFrame, frequency: str, today: Column,
                watermark: str = WATERMARK) -> DataFrame:
    """All source rows when a new load is due, none otherwise; nothing runs before."""
    newest = loaded.agg(F.max(watermark).cast("date")).scalar()
    return source.where(refresh_due(newest, today, frequency))


def refresh_dimension(source: DataFrame, target: str, frequency: str, today: Column,
                      stamp: Column, watermark: str = WATERMARK) -> bool:
    """Append a stamped copy of the source to an existing table if its newest load is due."""
    newest = read_table(source.sparkSession, target).agg(
        F.max(watermark).cast("date").alias("newest"))
    due = newest.select(refresh_due("newest", today, frequency)).first()[0]
    if due:
        write_table(source.withColumn(watermark, stamp), target)
    return due
