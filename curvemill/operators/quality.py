"""Checks as report tables. Only the two ``require_*`` functions run a job and fail."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def require_rows(inputs: Mapping[str, DataFrame]) -> None:
    """Fail with the names of all empty inputs; one job probes them together."""
    probes = [df.limit(1).select(F.lit(name).alias("name")) for name, df in inputs.items()]
    present = {r["name"] for r in reduce(DataFrame.union, probes).collect()}
    empty = [name for name in inputs if name not in present]
    if empty:
        raise ValueError(f"The following input tables are empty: {', '.join(empty)}")


def empty_inputs(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """One row per input: its name and whether it is empty; each probe reads one row."""
    return reduce(DataFrame.union, [
        df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))
        .select(F.lit(name).alias("input"), "is_empty") for name, df in inputs.items()])


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Fail when a lookup key occurs twice, which would multiply the rows it is joined to."""
    first = duplicate_keys(df, keys).limit(1).collect()
    if first:
        raise ValueError(f"{what} has duplicate keys, for example {first[0].asDict()}")


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def unmatched_keys(df: DataFrame, lookup: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Distinct keys of ``df`` that the lookup does not hold (``keys``: ours -> theirs)."""
    side = lookup.select(*[F.col(v).alias(f"_{k}") for k, v in keys.items()]).distinct()
    wanted = df.select(*keys).distinct()
    return wanted.join(side, [F.col(k) == F.col(f"_{k}") for k in keys], "left_anti")


def missing_lookups(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Distinct keys of the rows that a left join left without ``column``."""
    return df.where(F.col(column).isNull()).select(*keys).distinct()


def unmatched_shocks(exposure: DataFrame, shocks: DataFrame, curve: list[str],
                     tenor: str, tenors: str = "tenors") -> DataFrame:
    """Sorted tenors per curve for which exposure exists but no shock does.

    Both sides are reduced to their distinct points before they meet.
    """
    points = exposure.select(*curve, tenor).distinct()
    known = shocks.select(*curve, tenor).distinct()
    lost = points.join(known, [*curve, tenor], "left_anti")
    return lost.groupBy(*curve).agg(F.sort_array(F.collect_set(tenor)).alias(tenors))


def incomplete_curves(losses: DataFrame, counts: list[str], expected: int | Column) -> DataFrame:
    """Rows in which a tenor count is neither zero nor the full number of tenors."""
    bad = [(F.col(c) != 0) & (F.col(c) != expected) for c in counts]
    return losses.where(reduce(lambda a, b: a | b, bad))


def distinct_counts(df: DataFrame, keys: list[str], columns: Mapping[str, str]) -> DataFrame:
    """Number of different values per key; ``columns`` maps result names to columns."""
    return df.groupBy(*keys).agg(*[
        F.count_distinct(c).alias(name) for name, c in columns.items()])


def input_report(inputs: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Per input its rows and how many of them meet each named condition, one scan each."""
    parts = []
    for name, (df, conditions) in inputs.items():
        counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                         *[F.count_if(c).alias(check) for check, c in conditions.items()])
        cells = [F.struct(F.lit("rows").alias("check"), F.col("_rows").alias("found"))]
        cells += [F.struct(F.lit(check).alias("check"), F.col(check).alias("found"))
                  for check in conditions]
        parts.append(counted.select(F.lit(name).alias("input"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def counting(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Count conditions while ``df`` runs anyway; read them after the caller's action."""
    counted = Observation()
    return df.observe(counted, *[F.count_if(c).alias(n) for n, c in conditions.items()]), counted
