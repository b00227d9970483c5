"""Parquet base tables of a data directory, read lazily.

Each attribute is a plain ``spark.read.parquet`` scan; Catalyst prunes the
columns and pushes the filters of whatever plan consumes it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Scans of the base tables under ``root`` (``{root}/{name}.parquet``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)
