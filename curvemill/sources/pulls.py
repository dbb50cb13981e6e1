"""Pulls with an offset log: every new file of a source once, whatever stamps its rows carry.

A pull by watermark takes what is newer than the newest stamp on file and so loses rows that
arrive later under that stamp or an older one. Here a file stream keeps the files it has read
in a checkpoint, and the file sink keeps what it has committed in the target: a pull that is
killed at any point is repeated from the same files, and its earlier files are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# A file counts as new by its name alone, however old its time of change is.
ANY_AGE = "36500d"


def pull_new_files(spark: SparkSession, source: str, target: str, checkpoint: str,
                   schema: StructType | None = None, files_per_batch: int = 1000,
                   partition_by: list[str] | None = None,
                   shape: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Append the rows of all Parquet files that came to ``source`` since the last pull.

    Takes what is there now, in batches of at most ``files_per_batch`` files, and ends. Returns
    the rows read. ``shape`` may change the rows one by one (names, types, constants, filters).
    Files of the source must not be rewritten: under a new name their rows would come again.
    """
    schema = schema or spark.read.parquet(source).schema
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("maxFileAge", ANY_AGE).parquet(source))
    writer = ((shape or (lambda df: df))(rows).writeStream.format("parquet").outputMode("append")
              .option("path", target).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)
