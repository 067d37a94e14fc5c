"""Register of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Tables:
    """``t.orders`` and the like, read from one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.dir, name)


def query(sql: str | None = None, name: str | None = None):
    """Registers ``fn(t)``; without ``sql`` only the row count can be checked from outside."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
