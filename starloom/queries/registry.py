"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    """Register a function of `Tables` under its own name."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        REGISTRY[fn.__name__] = Query(run, sql)
        return fn

    return add


class Tables:
    """The tables of one folder, opened by attribute: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")
