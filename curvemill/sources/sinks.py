"""Audit columns and table writes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORTING = "reporting"
FORECASTING = "forecasting"
DAILY_FORECASTING = "daily_forecasting"
STRESS = "stress"
KINDS = (REPORTING, FORECASTING, DAILY_FORECASTING, STRESS)


def audit_kind(table: str, rules: list[tuple[list[str], str]]) -> str:
    """Kind of the first rule whose text parts all occur in the table name."""
    for parts, kind in rules:
        if all(part in table for part in parts):
            return kind
    raise ValueError(f"No audit rule for table {table}")


def add_audit_columns(df: DataFrame, kind: str, now: Column, zone: str, *,
                      reporting_date: date | Column | None = None,
                      valuation_date: date | Column | None = None) -> DataFrame:
    """Load stamp, run date and the dates of the given kind.

    ``now`` is the UTC clock of the load as a column (``F.current_timestamp()`` in a UTC
    session, or a literal); the stamp is its wall-clock time in ``zone``.
    """
    if kind not in KINDS:
        raise ValueError(f"Unknown audit kind: {kind}")
    stamp = F.from_utc_timestamp(now, zone)
    columns = {"ingestion_ts": stamp}
    if kind != STRESS:
        columns["reporting_date"] = _date(reporting_date)
    if kind == FORECASTING:
        columns["forecast_date"] = F.to_date(stamp)
    if kind == DAILY_FORECASTING:
        columns["forecast_date"] = _date(valuation_date)
    columns["run_date"] = F.to_date(stamp)
    return df.withColumns(columns)


def _date(value: date | Column | None) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def write_table(df: DataFrame, target: str, mode: str = "append",
                partition_by: str | None = None, path: str | None = None) -> None:
    """Append to a catalog table, or to a Parquet folder when ``target`` is a path.

    Partitioned writes are rebalanced first: Spark splits a large partition value over
    several tasks and gathers small ones, so neither hot values nor tiny files remain.
    """
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if "/" in target:
        writer.parquet(target)
    elif path:
        writer.option("path", path).saveAsTable(target)
    else:
        writer.saveAsTable(target)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int,
                   path: str | None = None, mode: str = "overwrite") -> None:
    """A catalog table in ``buckets`` files by the hash of ``keys``, each sorted by them.

    Two tables with the same buckets join on exactly these keys without an exchange. The rows
    move once, here, and each task writes one bucket as one file; choose ``buckets`` so that one
    holds 100 to 500 MB.
    """
    writer = (df.repartition(buckets, *keys).write.mode(mode)
              .bucketBy(buckets, *keys).sortBy(*keys))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
