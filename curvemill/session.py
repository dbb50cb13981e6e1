"""A Spark session with the settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps load stamps from being shifted twice. Adaptive execution coalesces small
# partitions, splits skewed ones and turns a join into a broadcast once sizes are known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g",
                  **settings: str) -> SparkSession:
    """A session on this machine; on a cluster the submit command sets the master."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("curvemill")
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", memory))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
