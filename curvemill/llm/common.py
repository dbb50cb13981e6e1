"""What the operators share: input columns, tables in the shared folder, set-wise helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curvemill.staging import shared_folder

# A measured side up to both sizes may be copied to every executor.
COPY_ROWS = 200_000
COPY_BYTES = 32 * 1024 * 1024

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Written:
    """A table in the shared folder with its rows and the bytes of its measured columns."""

    df: DataFrame
    rows: int
    bytes: int

    def copied(self) -> DataFrame:
        """For the small side of a join: copied to all tasks only if its size allows it."""
        small = self.rows <= COPY_ROWS and self.bytes <= COPY_BYTES
        return F.broadcast(self.df) if small else self.df


    def gathered(self) -> DataFrame:
        """In one partition if it is small, so that rounds over it need no shuffle."""
        return self.df.coalesce(1) if self.rows <= COPY_ROWS else self.df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_recorded: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that are written inside the block."""
    paths: list[str] = []
    _recorded.append(paths)
    try:
        yield paths
    finally:
        _recorded.remove(paths)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of ``write`` that nothing will read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write(df: DataFrame, name: str, texts: tuple[str, ...] = (), codec: str = "snappy",
          partition_by: tuple[str, ...] = ()) -> Written:
    """Write once to the shared folder and read back, which also cuts the lineage.

    Counts the rows and, of the string or binary columns ``texts``, the bytes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _recorded:
        paths.append(path)
    size = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(0))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"),
               F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes")) \
        .write.option("compression", codec).partitionBy(*partition_by).parquet(path)
    rows = seen.get["rows"]
    return Written(spark.read.schema(df.schema).parquet(path), rows,
                   rows * 8 * len(df.columns) + seen.get["bytes"])


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other signs as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))


def blank_words(text: Column) -> Column:
    """The words between ASCII blanks; none for a null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))
