"""Quantiles over many loads from stored sketches, refined to the exact value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvemill.operators.scenarios import quantile_by, quantile_values, rank_of, value_of_rank
from curvemill.sources.loads import read_loads, write_load
from curvemill.staging import stage

SIZE = 1000             # of a KLL sketch: 20 to 30 KB for any number of rows
MARGIN = 0.012          # ranks around p that a bracket takes in, several times the sketch's error


def sketch_groups(losses: DataFrame, keys: list[str], amount: str, size: int = SIZE) -> DataFrame:
    """One KLL sketch and the number of rows per group, reduced on the map side."""
    return losses.where(F.col(amount).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(amount).cast("double"), F.lit(size)).alias("sketch"),
        F.count(F.lit(1)).alias("sketch_rows"))


def store_sketches(losses: DataFrame, target: str, load: str, keys: list[str], amount: str,
                   size: int = SIZE) -> None:
    """Write the sketches of one load; a load written again replaces its sketches."""
    write_load(sketch_groups(losses, keys, amount, size).withColumn("sketched", F.lit(1)), target, load,
               "sketched")


def quantile_of_loads(losses: DataFrame, sketches: DataFrame, keys: list[str], amount: str,
                      quantile: str, p: float = 0.95, margin: float = MARGIN) -> DataFrame:
    """Quantile per group of all loads: the value of rank ceil(p * rows), exactly.

    The merged sketches of the loads give the bracket, so the losses are read once, for the
    values inside it. A bracket of sketches holds the rank with high probability, not for
    certain; where the counts show that it does not, the group goes the way of ``quantile_by``.
    The sketches must be those of the given losses: a load without its sketches shifts the rank.
    """
    names, values = quantile_values(losses, keys, amount)
    values = values.withColumn("_value", F.col("_value").cast("double"))
    merged = sketches.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        F.kll_merge_agg_double("sketch").alias("_sketch"), F.sum("sketch_rows").alias("_n"))

    def at(rank: float):
        return F.kll_sketch_get_quantile_double("_sketch", F.lit(min(max(rank, 0.0), 1.0)))

    near = stage(merged.select(*names, "_n", rank_of("_n", p).alias("_rank"), at(p - margin).alias("_low"),
                               at(p + margin).alias("_high")), "brackets").df
    found = stage(near.select(*names, "_n").join(
        value_of_rank(values, near, names).select(*[F.col(n).alias(f"_{n}") for n in names], "_found"),
        [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names], "left").select(*names, "_n", "_found"),
        "quantiles").df
    missed = stage(found.where("_found is null").drop("_found"), "missed")
    out = found.where("_found is not null")
    if missed.rows:
        left = missed.df.select(*[F.col(n).alias(f"_{n}") for n in names])
        rest = values.join(left, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names], "left_semi")
        out = out.drop("_n").unionByName(quantile_by(rest, names, "_value", "_found", p))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], F.col("_found").alias(quantile))


def read_sketches(spark: SparkSession, target: str) -> DataFrame:
    """The sketches of all loads."""
    return read_loads(spark, target)
