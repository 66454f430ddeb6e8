"""Registration of a Spark query together with the SQL that has to give the same rows."""

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables under one scale folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)  # the file listing is done once per query
        return frame


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under `name`."""

    def register(build: Callable[[Tables], DataFrame]):
        @functools.wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
