"""Tables of loads: writes that can be repeated, and a manifest that names the newest load.

A load is a folder ``load_id=...`` of Parquet files. Beside the loads the folder ``_loads`` keeps
the manifest: a few rows per load with its newest stamp for every slice. Reading the newest
load asks the manifest first and then opens the files of that load only; no other load is
listed or scanned. Spark's readers skip ``_loads`` when they read the whole table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curvemill.sources.snapshots import WATERMARK

LOAD = "load_id"
MANIFEST = "_loads"
NEWEST, ROWS = "newest_stamp", "load_rows"


def write_load(df: DataFrame, target: str, load: str, stamp: str = WATERMARK,
               slices: Sequence[str] = ()) -> int:
    """Write ``df`` as the load of that name and return its rows.

    The same load written again replaces its first copy and no other load (dynamic partition
    overwrite), so a job can be repeated. The files are committed first and the manifest after
    them: a load that breaks off between the two is not the newest of anything until it is
    repeated. ``slices`` are the columns by which the newest load is asked for. A load without
    rows removes an earlier copy.
    """
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_.-]*", load):
        raise ValueError(f"A load is named by a letter, then letters, digits and _.-: {load!r}")
    spark, seen = df.sparkSession, Observation()
    _replace(df.observe(seen, F.count(F.lit(1)).alias("rows")), target, load)
    if not seen.get["rows"]:
        for folder in (f"{target}/{LOAD}={load}", f"{target}/{MANIFEST}/{LOAD}={load}"):
            _remove(spark, folder)
        return 0
    written = spark.read.schema(df.schema).parquet(f"{target}/{LOAD}={load}")
    entry = written.groupBy(*slices).agg(F.max(stamp).alias(NEWEST), F.count(F.lit(1)).alias(ROWS))
    _replace(entry.coalesce(1), f"{target}/{MANIFEST}", load)
    return seen.get["rows"]


def _replace(df: DataFrame, folder: str, load: str) -> None:
    df.withColumn(LOAD, F.lit(load)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(folder)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """A row per load and slice: the slice columns, newest_stamp, load_rows, load_id."""
    return spark.read.parquet(f"{target}/{MANIFEST}")


def read_loads(spark: SparkSession, target: str) -> DataFrame:
    """All rows of all loads, with the name of the load."""
    return spark.read.parquet(target)


def read_newest(spark: SparkSession, target: str, where: str | Column | None = None,
                stamp: str = WATERMARK) -> DataFrame:
    """Rows of the newest load among the rows that pass ``where``, a condition on the slices.

    Only the names of the loads that hold the newest stamp come to the driver, as a rule one.
    """
    entries = manifest(spark, target)
    if where is not None:
        entries = entries.where(where)
    newest = entries.agg(F.max(NEWEST)).scalar()
    names = [r[0] for r in entries.where(F.col(NEWEST) == newest).select(LOAD).distinct().collect()]
    if not names:
        return read_loads(spark, target).where("false")
    rows = spark.read.option("basePath", target).parquet(*[f"{target}/{LOAD}={n}" for n in names])
    if where is not None:
        rows = rows.where(where)
    return rows.where(F.col(stamp) == newest)
