"""Dimensions kept by difference: only what is new, changed or ended is appended."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvemill.sources.loads import LOAD, MANIFEST, NEWEST, manifest, read_loads, write_load
from curvemill.staging import stage

SINCE, CHANGE, HASH = "valid_from", "change", "row_hash"
NEW, CHANGED, ENDED = "new", "changed", "ended"


def row_hash(columns: list[str]) -> Column:
    """SHA-256 over the values of a row; a null differs from every text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def state_at(history: DataFrame, keys: list[str], day: date | None = None) -> DataFrame:
    """The rows that are valid on a day (now, without one), one per key.

    The newest entry of each key counts, unless it says that the key has ended. An aggregate
    with a total order, reduced before the shuffle.
    """
    entries = history if day is None else history.where(F.col(SINCE) <= F.lit(day))
    rest = [c for c in history.columns if c not in keys]
    newest = entries.groupBy(*keys).agg(F.max(F.struct(SINCE, *[c for c in rest if c != SINCE])).alias("_e"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_e.{c}").alias(c) for c in history.columns]) \
        .where(F.col(CHANGE) != ENDED)


def differences(current: DataFrame, source: DataFrame, keys: list[str], since: date) -> DataFrame:
    """What changes ``current`` (of ``state_at``) into ``source``: rows of the history.

    A full outer join on the keys compares the hashes of the rows, so of the current state only
    keys and hashes are read until a key has ended. Keys must be unique in the source and not
    null: the query fails otherwise.
    """
    columns = source.columns
    values = [c for c in columns if c not in keys]
    hashed = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct(F.lit(0).alias("_"), *values)).alias("_v"))
    hashed = hashed.select(*keys, "_n", *[F.col(f"_v.{c}").alias(c) for c in values])
    wrong = F.col("_n") > 1
    for k in keys:
        wrong = wrong | F.col(k).isNull()
    fail = F.raise_error(F.lit(f"The keys {', '.join(keys)} of a dimension are not unique or null"))
    hashed = hashed.withColumn("_new", F.when(wrong, fail.cast("string")).otherwise(row_hash(columns)))
    old = current.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(HASH).alias("_old"))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    change = (F.when(F.col("_old").isNull(), F.lit(NEW)).when(F.col("_new").isNull(), F.lit(ENDED))
              .when(F.col("_old") != F.col("_new"), F.lit(CHANGED)))
    compared = hashed.join(old, same, "full").withColumn(CHANGE, change).where(F.col(CHANGE).isNotNull())
    return compared.select(
        *[F.coalesce(k, f"_{k}").alias(k) if k in keys else F.col(k) for k in columns],
        F.lit(since).alias(SINCE), CHANGE, F.coalesce("_new", "_old").alias(HASH))


def refresh_by_difference(spark: SparkSession, source: DataFrame, target: str, keys: list[str],
                          since: date, load: str) -> int:
    """Append the differences of ``source`` to the history in ``target``; returns their number.

    ``since`` is the day from which the new state holds; it must be later than that of all other
    refreshes. Each refresh is a load: repeated under the same name it compares with the state
    before it and replaces its own entries. The first refresh makes the history.
    """
    if not _is_there(spark, target):
        first = source.select("*", F.lit(since).alias(SINCE), F.lit(NEW).alias(CHANGE), F.lit("").alias(HASH))
        return write_load(differences(first.where("false"), source, keys, since), target, load, SINCE)
    others = manifest(spark, target).where(F.col(LOAD) != load)
    newest = others.agg(F.max(NEWEST)).first()[0]
    if newest is not None and newest >= since:
        raise ValueError(f"The history in {target} goes on to {newest}, the refresh is of {since}")
    history = read_loads(spark, target).where(F.col(LOAD) != load).select(*keys, SINCE, CHANGE, HASH)
    entries = differences(state_at(history, keys), source, keys, since)
    return write_load(stage(entries, "differences").df, target, load, SINCE)


def _is_there(spark: SparkSession, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{MANIFEST}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def state_of(spark: SparkSession, target: str, keys: list[str], day: date | None = None) -> DataFrame:
    """The dimension as it was on a day (as it is, without one), in the columns of its source."""
    return state_at(read_loads(spark, target).drop(LOAD), keys, day).drop(SINCE, CHANGE, HASH)
