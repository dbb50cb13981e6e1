"""Column shaping at ingest: names, types, constants, fills and tagged unions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail early when a mandatory column is absent."""
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise ValueError(f"Mandatory columns are missing: {', '.join(missing)}")
    return df


def rename_columns(df: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    if len(old) != len(new):
        raise ValueError("The lists of old and new column names differ in length")
    require_columns(df, old)
    return df.withColumnsRenamed(dict(zip(old, new)))


def normalize_names(df: DataFrame) -> DataFrame:
    """Upper-case names in which every run of other signs becomes one underscore."""
    names = [re.sub(r"[^0-9A-Za-z]+", "_", c.strip()).strip("_").upper() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"Column names collide after normalisation: {names}")
    return df.toDF(*names)


def name_positions(df: DataFrame, positions: list[int], names: list[str]) -> DataFrame:
    """Keep the columns at these positions of a headerless extract, under new names."""
    kept = [df.columns[i] for i in positions]
    return df.select(*kept).toDF(*names)


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns; None becomes a typed (string) null."""
    return df.withColumns({
        name: F.lit(None).cast("string") if value is None else F.lit(value)
        for name, value in values.items()})


def override_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns; a value that does not convert becomes null."""
    require_columns(df, list(types))
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def exclude_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Drop rows whose value is listed; rows without a value stay."""
    col = F.col(column)
    return df.where(col.isNull() | ~col.isin(values))


def union_feeds(feeds: list[DataFrame], fill_missing: bool = False) -> DataFrame:
    """All rows of all feeds, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), feeds)


def tagged_union(feeds: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union by name in which each feed carries its own name in the tag column."""
    return union_feeds([df.withColumn(tag, F.lit(name)) for name, df in feeds.items()])


def forward_fill(df: DataFrame, columns: list[str], order: list[str], chunk: Column,
                 keys: list[str] | None = None) -> DataFrame:
    """Replace nulls by the last earlier value of the same key, in the given order.

    The rows of a key are cut into consecutive pieces by ``chunk`` (a day, a range of
    positions), which must grow with ``order``; where two pieces overlap the query fails.
    What a piece inherits from the pieces before it comes from one summary row per piece,
    reduced on the map side; that row is put in front of the piece and the window runs
    inside the piece only. Small and large keys take the same way, no task holds more of the
    rows than one piece, and the rows are shuffled once.
    """
    keys = keys or []
    pieces = df.withColumns({"_chunk": chunk, "_body": F.lit(1)})
    position = F.struct(*order)
    last = pieces.groupBy(*keys, "_chunk").agg(
        F.min(position).alias("_from"), F.max(position).alias("_to"), *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(position, F.col(c)))).getField(c)
            .alias(c) for c in columns])
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    overlap = F.max("_to").over(earlier) > F.col("_from")
    heads = last.select(*keys, "_chunk", F.when(overlap, F.raise_error(F.lit(
        "chunk does not grow with the order")).cast("int")).otherwise(0).alias("_body"), *[
        F.last(c, ignorenulls=True).over(earlier).alias(c) for c in columns])
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_body", *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = pieces.unionByName(heads, allowMissingColumns=True).withColumns(
        {c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    return filled.where("_body = 1").select(*df.columns)
