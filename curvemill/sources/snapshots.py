"""Reading append-only tables: newest load, date context, shock set of a date."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from curvemill.functions.calendar import quarter_end

WATERMARK = "ingestion_ts"


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """All loads of a catalog table or of a Parquet folder."""
    if "/" in source:
        return spark.read.parquet(source)
    return spark.read.table(source)


def read_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text; ``{name}`` in the text stands for the DataFrame passed as ``name``."""
    return spark.sql(sql, **tables)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A relation written in code, without repeated rows.

    It goes in as an Arrow table, which makes it a local relation: Spark knows its size
    (and broadcasts it) and needs no Python worker to read it.
    """
    types = T.StructType.fromDDL(schema)
    unique = list(dict.fromkeys(rows))
    table = pa.table([pa.array([r[i] for r in unique], to_arrow_type(f.dataType))
                      for i, f in enumerate(types)], names=types.names)
    return spark.createDataFrame(table, types)


def latest_snapshot(table: DataFrame, where: str | Column | None = None,
                    watermark: str = WATERMARK) -> DataFrame:
    """Rows of the newest load among the rows that pass ``where``.

    The filter comes first, so another slice loaded later does not hide this one. The
    newest stamp is a scalar subquery over the filter and watermark columns only; both
    scans get the filter pushed down.
    """
    rows = table if where is None else table.where(where)
    newest = rows.agg(F.max(watermark)).scalar()
    return rows.where(F.col(watermark) == newest)


def shock_set_for_date(dates: DataFrame, sets: DataFrame, day: str, effective: str,
                       not_after: bool = False) -> DataFrame:
    """Add to each day the effective date of the shock set that is valid for it.

    The set of the quarter holding the day, else the newest set on file. With
    ``not_after`` the fallback is the newest set that is not later than the day.
    """
    on_file = sets.select(F.col(effective).cast("date").alias("on_file")) \
        .where("on_file is not null").distinct()
    # One entry per quarter end on file, so the list stays short.
    listed = on_file.agg(F.sort_array(F.collect_list("on_file"))).scalar()
    quarter = quarter_end(day)
    if not_after:
        fallback = F.array_max(F.filter("_sets", lambda x: x <= F.col(day)))
    else:
        fallback = F.element_at("_sets", -1)
    return (dates.withColumn("_sets", listed)
            .withColumn(effective, F.when(F.array_contains("_sets", quarter), quarter)
                        .when(F.size("_sets") > 0, fallback))
            .drop("_sets"))


def date_context(dates: DataFrame, forecasts: DataFrame, today: Column, *, day: str,
                 forecast_day: str, order: list[str], watermark: str = WATERMARK,
                 forecast_watermark: str = WATERMARK) -> DataFrame:
    """One row: the date row of today beside the newest forecast date not after today.

    Both sides are taken inside their newest load. ``order`` decides between several
    date rows of the same day. The result is empty when either side has no row.
    """
    current = (latest_snapshot(dates, watermark=watermark)
               .where(F.col(day) == today).orderBy(*order).limit(1))
    forecast = (latest_snapshot(forecasts, watermark=forecast_watermark)
                .where(F.col(forecast_day) <= today)
                .orderBy(F.col(forecast_day).desc(), *forecasts.columns).limit(1))
    beside = F.struct(*[c for c in forecast.columns if c != forecast_watermark])
    return (current.drop(watermark)
            .withColumn("_forecast", forecast.select(beside).scalar())
            .where("_forecast is not null")
            .select("*", "_forecast.*").drop("_forecast"))


def require_context(context: DataFrame, field: str) -> Row:
    """The one context row on the driver; fails when it or its key field is missing."""
    row = context.first()
    if row is None:
        raise ValueError("No date context row: today or a forecast date is not on file")
    if row[field] is None:
        raise ValueError(f"The date context has no value for {field}: {row.asDict()}")
    return row
