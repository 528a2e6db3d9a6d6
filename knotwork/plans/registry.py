"""Registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[["Tables"], DataFrame]


class Tables:
    """Lazy access to the test tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its key, with the SQL text that must give the same rows."""

    def register(run: Run) -> Run:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register
