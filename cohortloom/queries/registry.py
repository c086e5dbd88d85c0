"""Query registry: name -> callable, name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes, e.g. ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")


def query(sql: str):
    """Register a function of ``Tables`` under its own name together with its SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        ORACLES[fn.__name__] = sql
        return fn

    return register
