"""Sources and sinks.

Tables are versioned parquet folders committed by a pointer (``commit``): a stopped job leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import clean, sampling
from .commit import read_table, replace_table


def csv_scan(spark: SparkSession, path: str) -> DataFrame:
    """A1: vendor CSV with a header, every column as STRING, malformed lines dropped."""
    return spark.read.option("header", True).option("mode", "DROPMALFORMED").option("inferSchema", False).csv(path)


def load_replace(spark: SparkSession, raw: DataFrame, out: str, data_source: str = "vendor") -> int:
    """A3: idempotent load: clean, probe for one usable row **before** replacing the table,
    then overwrite; raises when nothing is usable.  Returns the row count written."""
    typed = clean.applications(raw, data_source)
    if not typed.limit(1).count():  # probe: one row is enough
        raise ValueError("no usable rows in the input; table left unchanged")
    return replace_table(typed, out)


def applications(df: DataFrame, date: str | None = None, limit: int | None = None,
                 date_col: str = "application_date", id_col: str = "application_id") -> DataFrame:
    """A4: optional ``date_col <= date``, ordered by (date, id), optional limit (top-k)."""
    out = df if date is None else df.where(F.col(date_col) <= F.to_date(F.lit(date)))
    out = out.orderBy(date_col, id_col)
    return out if limit is None else out.limit(limit)


def payments(df: DataFrame, ids: DataFrame | None = None, id_col: str = "application_id") -> DataFrame:
    """A5: all payments, or only those of the loans in ``ids`` (left semi join)."""
    return df if ids is None else df.join(ids.select(id_col), id_col, "left_semi")


def feature_dataset(features: DataFrame, applications_df: DataFrame, train_end: str, val_end: str,
                    version: str = "v1.0", keep: Sequence[str] = ()) -> DataFrame:
    """A6 (+ D1, H1): snapshot rows of one version joined to the loan label and date (and the loan's columns ``keep``), with a
    split label."""
    f = features.where(F.col("feature_version") == version)  # D1: partition filter when stored by version
    a = applications_df.select("application_id", "application_date", "is_default", *keep)
    return sampling.time_split(f.join(a, "application_id", "inner"), train_end, val_end)


def snapshot_write(df: DataFrame, path: str) -> None:
    """Replace the snapshot table, partitioned by feature_version."""
    replace_table(df, path, ("feature_version",))


def predictions_replace(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Drop previous batch scores (model_version LIKE 'batch:%'), keep the rest, add the new batch."""
    return existing.where(~F.col("model_version").like("batch:%")).unionByName(new)


def predictions_commit(spark: SparkSession, path: str, new: DataFrame) -> int:
    """The same on a stored table, delete and append as one commit; returns its row count."""
    return replace_table(predictions_replace(read_table(spark, path), new), path)


def export_recent_subset(raw: DataFrame, n: int, date_col: str = "issue_d", id_col: str = "id") -> DataFrame:
    """A10: vendor rows with a parsable issue date, the newest ``n`` by (date, id) (a top-k)."""
    d = F.coalesce(F.try_to_timestamp(F.trim(F.col(date_col)), F.lit("MMM-yyyy")),
                   F.try_to_timestamp(F.trim(F.col(date_col)), F.lit("yyyy-MM-dd"))).cast("date")
    dated = raw.withColumn("_issue_date", d).where(F.col("_issue_date").isNotNull())
    return dated.orderBy(F.col("_issue_date").desc(), F.col(id_col).desc()).limit(n)


def metrics_export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a small report table (CSV with header, or parquet)."""
    w = df.write.mode("overwrite")  # as many files as the last exchange leaves; adaptive execution merges small ones
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
