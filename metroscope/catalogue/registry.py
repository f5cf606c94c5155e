"""Registration of catalogue entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The benchmark tables of one scale folder, opened on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        # The tables hold wall-clock timestamps; the SQL side reads them as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def entry(key: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``key`` with its SQL equivalent."""

    def register(build: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise KeyError(f"{key} registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLES[key] = sql
        return build

    return register
