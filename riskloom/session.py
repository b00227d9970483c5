"""Spark session and shared-storage helpers.

Every job in the package is a lazy DataFrame plan; this module only builds the
session and resolves the shared checkpoint folder.  On a cluster the folder
comes from ``spark.checkpoint.dir`` (a shared file system path set by the
cluster operator).  Only a local test session gets a scratch folder of its own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet pushdown of date/timestamp/decimal predicates is on by default;
    # keep it explicit because the feature jobs lean on it.
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "riskloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("RISKLOOM_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session.  A local-mode session (tests, bench) without the
    setting gets a fresh scratch folder; a cluster session without it is an
    error, because a machine-local folder would not survive executor loss.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="riskloom-ckpt-", dir=os.environ.get("RISKLOOM_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def written(path: str) -> str:
    """Note a folder for ``drop_materialised``, and for the ``scratch`` block it is written in."""
    _WRITTEN.append(path)
    if (mine := _SCRATCH.get()) is not None:
        mine.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """A block whose tables (those that its own thread writes) are deleted at its end, so that steps run one after the other
    hold the disk of one step.  A folder taken out of the list it yields stays.

    Shuffle files go with the last plan that can read them; a collection on both sides makes that now."""
    mine: list[str] = []
    token = _SCRATCH.set(mine)
    try:
        yield mine
    finally:
        _SCRATCH.reset(token)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for name in mine:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)
            _WRITTEN.remove(name)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it from there.

    Survives executor loss; unlike a checkpoint it is computed once, and its readers prune columns and push filters.
    The folders last as long as the application; ``drop_materialised`` deletes them.
    """
    path = written(f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialised(spark: SparkSession) -> int:
    """Delete the tables that ``materialise`` wrote in this application; returns their number."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(hadoop).delete(path, True))
    return n


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several jobs read: a table in the shared folder."""
    return materialise(df, "cut")
