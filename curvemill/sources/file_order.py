"""The order of rows in their files, for extracts that carry no order of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.operators.shaping import forward_fill
from curvemill.staging import stage

PIECE = 1_000_000       # consecutive rows that are filled by one task


def file_positions(df: DataFrame, position: str = "position") -> DataFrame:
    """A DataFrame as read from files, with the place of each row: by file path, then by row.

    Places run from 0 without gaps over all files. Within a split of a file the rows are counted
    as they are read; a split begins where the counts of those before it end. Only one row per
    split is sorted. The rows are staged once, so that both steps see the same splits.
    """
    rows = stage(df.select("*", F.col("_metadata.file_path").alias("_file"),
                           F.col("_metadata.file_block_start").alias("_start"),
                           F.monotonically_increasing_id().alias("_id")), "in-files").df
    before = Window.orderBy("_path", "_begin").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy(F.col("_file").alias("_path"), F.col("_start").alias("_begin")).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    splits = stage(splits.select("_path", "_begin", (F.coalesce(F.sum("_n").over(before), F.lit(0))
                                                     - F.col("_first")).alias("_shift")), "splits")
    side = F.broadcast(splits.df) if splits.fits() else splits.df
    placed = rows.join(side, (F.col("_file") == F.col("_path")) & (F.col("_start") == F.col("_begin")))
    return placed.select(*df.columns, (F.col("_id") + F.col("_shift")).alias(position))


def fill_in_file_order(df: DataFrame, columns: list[str], piece: int = PIECE) -> DataFrame:
    """Nulls of ``columns`` replaced by the last earlier value in the files; see ``forward_fill``."""
    placed = file_positions(df, "_position")
    chunk = F.floor(F.col("_position") / piece)
    return forward_fill(placed, columns, ["_position"], chunk).select(*df.columns)
