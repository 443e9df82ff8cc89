"""The catalog of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """Lazy access to the parquet tables of one folder: ``t.orders``."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    covers: tuple[str, ...]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


CATALOG: dict[str, Query] = {}


def query(*covers: str, sql: str | None = None):
    """Register a plan under its function name with the inventory items it shows."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Query(name, build, covers, sql)
        return build

    return register
