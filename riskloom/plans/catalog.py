"""Registered queries: name -> (spark, data_dir) -> DataFrame, and their oracle SQL.

Each entry reads the driver's base tables through the loan views of
``riskloom.sources.fixtures`` and runs one operator (or a pipeline) over the
whole tables.  Report outputs round DOUBLE columns (6 decimals unless noted)
so both engines agree on the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (each registers its entries)."""
    from . import q_features, q_clean, q_reports, q_quality, q_sampling, q_metrics, q_drift, q_profile, q_models, q_io, q_stream  # noqa: F401
