"""Intermediate tables in the cluster's shared folder, with their measured size.

A staged table cuts lineage, survives the loss of executors and has a known size.
Every explicit broadcast in the library is decided on the size taken here.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

# What a staged side may hold at most to be copied to every executor.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Types that take one 8-byte word of a row; the others add the length of their text.
WORD_TYPES = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Staged:
    """A written DataFrame, its number of rows and the bytes of its values."""

    df: DataFrame
    rows: int
    bytes: int

    def fits(self, limit: int = BROADCAST_ROWS) -> bool:
        return self.rows <= limit and self.bytes <= BROADCAST_BYTES


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Without that setting it is a folder beside the session's tables, which a cluster shares
    as well.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder shared by all executors")
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse')}/_staged"
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> Staged:
    """Write ``df`` once and read it back; rows and text are measured during the write."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
             for f in df.schema if not isinstance(f.dataType, WORD_TYPES)]
    text = F.sum(sum(texts, F.lit(0)).cast("bigint"))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"),
               F.coalesce(text, F.lit(0)).alias("text")).write.parquet(path)
    rows = seen.get["rows"]
    return Staged(spark.read.schema(df.schema).parquet(path), rows,
                  rows * 8 * len(df.columns) + seen.get["text"])


def join_small(large: DataFrame, small: Staged, on: list[str],
               limit: int = BROADCAST_ROWS) -> DataFrame:
    """Inner many-to-many join on a few, possibly hot, key values.

    A small side that fits is broadcast. Beyond that it is a shuffle join in which the large
    side moves once: adaptive execution splits the partitions of hot keys and reads only the
    other side's partition again for each split.
    """
    if small.fits(limit):
        return large.join(F.broadcast(small.df), on)
    return large.join(small.df, on)
