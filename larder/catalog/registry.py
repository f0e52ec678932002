"""Registry of queries over the shared test tables, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Attribute access to the parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under an inventory id."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn

    return register
