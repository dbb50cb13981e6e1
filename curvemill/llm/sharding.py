"""A uniform shuffle into shards of exact sizes by a communication matrix.

How many rows go from each source part to each shard is drawn first, from the multivariate
hypergeometric law; each part is permuted on its own and dealt out by its counts; each
shard is permuted again. Every row may end in every slot, all orders alike.

A part is a set of whole files, and a row's place in it follows from its file and its number in
the file. Both permutations are keyed Feistel networks over exactly the rows of a part or a
shard, so every task knows shard and slot of a row from its place alone: whole rows move once,
to their shard, and nothing has to be numbered by a sort.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.common import fresh, write

PARTS = 1024            # source parts, at most
CELLS = 4_000_000       # of the matrix, at most: with more shards there are fewer parts
ROUNDS = 8              # of a permutation
PER_PARTITION = 4       # runs of slots that a shuffle partition gets, on average
LIMIT = 500_000_000     # rows in a draw by numpy, at most: its sampler ends below a billion


def drawn(random: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` rows out of good + bad are good, for any number of rows.

    Each row is taken with one chance; of the rows taken too many, or still missing, a uniform
    choice is put back or added. What is taken is then uniform among all sets of its size.
    """
    total = good + bad
    if total <= LIMIT:
        return int(random.hypergeometric(good, bad, sample))
    share = sample / total
    a, b = int(random.binomial(good, share)), int(random.binomial(bad, share))
    more = sample - a - b
    first, of = (good - a, total - a - b) if more > 0 else (a, a + b)
    changed = int((random.choice(of, abs(more), replace=False) < first).sum()) if more else 0
    return a + changed if more > 0 else a - changed


def communication_matrix(rows: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Counts of rows from each part (first axis) to each shard (second axis).

    Rows sums are the parts' sizes and shard sizes are at most one apart. Parts are drawn
    one after the other from what the shards still lack, by one law at every size.
    """
    random = np.random.default_rng(seed)
    matrix, n = np.zeros((len(rows), shards), np.int64), int(rows.sum())
    lack = np.array([-((s - n) // shards) for s in range(shards)], np.int64)
    for part, size in enumerate(rows):
        if lack.sum() <= LIMIT:
            matrix[part] = random.multivariate_hypergeometric(lack, int(size))
        else:
            left, rest = int(size), int(lack.sum())
            for s in range(shards):
                rest -= int(lack[s])
                matrix[part, s] = drawn(random, int(lack[s]), rest, left)
                left -= int(matrix[part, s])
        lack -= matrix[part]
    return matrix


def _mixed(key: np.ndarray, number: int, value: np.ndarray) -> np.ndarray:
    """A hash of 64 bits of key, round and value: two multiplications with shifts between."""
    step = np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    x = key + step + value * np.uint64(0xD1B54A32D192ED03)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def keys_of(seed: int, kind: int, count: int) -> np.ndarray:
    """A key per part (kind 1) or shard (kind 2)."""
    one = np.full(count, seed, np.int64).astype(np.uint64)
    return _mixed(one, kind, np.arange(count).astype(np.uint64))


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Each x, from 0 to n - 1, at its place in the permutation of its key.

    A Feistel network permutes a grid that is hardly larger than n; what leaves the range goes
    through it again until it is back inside, which keeps the map one-to-one.
    """
    with np.errstate(over="ignore"):
        n, out = n.astype(np.uint64), x.astype(np.uint64)
        a = np.maximum(np.ceil(np.sqrt(n.astype(np.float64))).astype(np.uint64), np.uint64(1))
        b = (n + a - np.uint64(1)) // a
        left = np.arange(len(out))
        while len(left):
            size, width, own = a[left], b[left], key[left]
            high, low = out[left] // width, out[left] % width
            for i in range(ROUNDS):
                if i % 2:
                    low = (low + _mixed(own, i, high) % width) % width
                else:
                    high = (high + _mixed(own, i, low) % size) % size
            out[left] = high * width + low
            left = left[out[left] >= n[left]]
    return out.astype(np.int64)


def places(matrix: np.ndarray, part: np.ndarray, at: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of the rows with these places in their parts."""
    parts, shards = matrix.shape
    sizes, totals = matrix.sum(axis=1), matrix.sum(axis=0)
    rank = permuted(at, sizes[part], keys_of(seed, 1, parts)[part])
    ends = np.cumsum(matrix.ravel())                   # of the runs that go to one shard
    run = np.searchsorted(ends, np.cumsum(sizes)[part] - sizes[part] + rank, "right")
    shard = run - part * shards
    first = ends[run] - matrix.ravel()[run]            # of the run, over all parts
    earlier = (np.cumsum(matrix, axis=0) - matrix)[part, shard]
    place = np.cumsum(sizes)[part] - sizes[part] + rank - first + earlier
    return shard, permuted(place, totals[shard], keys_of(seed, 2, shards)[shard])


def _in_files(df: DataFrame) -> DataFrame:
    """``df`` if it is a plain read of Parquet files, else the files it was written to."""
    plan = df._jdf.queryExecution().analyzed().toString()
    nodes = {m[1] for m in re.finditer(r"(?m)^[ +:-]*(\w+)", plan)}
    if nodes <= {"Project", "Relation", "SubqueryAlias"} and "parquet" in plan.rsplit("Relation", 1)[-1]:
        return df
    return write(df, "shard-rows", codec="zstd").df


def deal(df: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and the gapless ``slot`` in it.

    Sizes of shards are at most one apart. Rows are told apart by file and place, so nulls, ties,
    repeated rows and very long texts are rows like all others; an empty table gives an empty
    one. The same files under the same seed are dealt the same way however Spark cuts them into
    tasks; other DataFrames are written to files first, and these count. Columns named shard or
    slot would clash: ValueError.
    """
    if {"shard", "slot"} & {c.lower() for c in df.columns}:
        raise ValueError("The rows already have a column named shard or slot")
    spark, rows = df.sparkSession, _in_files(df)
    meta = rows.metadataColumn("_metadata")
    path, at, part, base, place = (fresh(df, x) for x in ("path", "at", "part", "base", "place"))
    parts = max(1, min(PARTS, CELLS // shards))
    order = Window.orderBy("file")
    files = rows.select(meta["file_path"].alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    files = files.withColumn(part, ((F.row_number().over(order) - 1) % parts).cast("int"))
    before = Window.partitionBy(part).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = write(files.withColumn(base, F.coalesce(F.sum("n").over(before), F.lit(0))), "shard-files", ("file",))
    sizes = np.zeros(parts, np.int64)
    for p, n in files.df.groupBy(part).agg(F.sum("n")).collect():
        sizes[p] = n
    matrix = communication_matrix(sizes, shards, seed)

    @F.pandas_udf("shard bigint, slot bigint")
    def of(part: pd.Series, at: pd.Series) -> pd.DataFrame:
        shard, slot = places(matrix, part.to_numpy().astype(np.int64), at.to_numpy(), seed)
        return pd.DataFrame({"shard": shard, "slot": slot})

    placed = rows.select("*", meta["file_path"].alias(path), meta["row_index"].alias(at))
    placed = placed.join(files.copied().select(F.col("file").alias(f"{path}_"), part, base),
                         F.col(path) == F.col(f"{path}_"))
    placed = placed.withColumn(place, of(part, F.col(base) + F.col(at))).select(
        *df.columns, F.col(place)["shard"].alias("shard"), F.col(place)["slot"].alias("slot"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = max(1, partitions * PER_PARTITION // shards)
    width = max(1, -(-int(sizes.sum()) // (shards * runs)))
    return placed.repartition(partitions, "shard", F.floor(F.col("slot") / width)) \
        .sortWithinPartitions("shard", "slot")
