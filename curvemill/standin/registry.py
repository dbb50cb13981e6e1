"""Registry of check queries: each name holds a Spark query and the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Schema per file, so that each footer is read by one job and not by every query.
SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The Parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)


def check(sql: str, name: str | None = None):
    """Register a query ``(Tables) -> DataFrame`` under its function name or ``name``."""

    def register(query: Callable[[Tables], DataFrame]):
        key = name or query.__name__
        QUERIES[key] = lambda spark, folder: query(Tables(spark, folder))
        SQL[key] = sql
        return query

    return register
