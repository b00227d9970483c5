"""Tables committed by a pointer: a folder per version, and one small file that names the current one.

A commit writes its rows into a new version folder and, when that job has succeeded, replaces the pointer file in one
step.  Readers resolve the pointer first, so they see the old version or the new one and never a table that is absent
or half written: a job that stops before the pointer is replaced leaves only an unused folder, one that stops after it
leaves only an old one.  ``vacuum`` deletes both kinds; the version before the current one is kept for readers that
have just resolved it.

A folder without a pointer is read as the plain Parquet table it is, and becomes a versioned one with its first commit.
With two writers at once the later pointer wins, and each version is whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER, VERSIONS = "CURRENT", "_versions"
#: stores whose files appear as a whole when they are closed, but whose rename copies
OBJECT_STORES = ("s3", "s3a", "gs", "abfs", "abfss", "wasb", "wasbs", "oss")


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _store(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    return _store(spark, name).exists(_path(spark, name))


def current(spark: SparkSession, table: str) -> str | None:
    """Folder of the table's current version; None for a folder without a pointer."""
    table = table.rstrip("/")
    store, pointer = _store(spark, table), f"{table}/{POINTER}"
    if not store.exists(_path(spark, pointer)):
        return None
    stream = store.open(_path(spark, pointer))
    try:
        name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{table}/{VERSIONS}/{name}"


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The table's current version."""
    return spark.read.parquet(current(spark, table) or table)


def current_tag(spark: SparkSession, table: str) -> str | None:
    """What the writer of the current version named it by; None without a version or a tag."""
    now = current(spark, table)
    return (now.rsplit("/", 1)[1].split("-", 2) + [""])[2] or None if now else None


def write_version(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), tag: str = "") -> str:
    """Write ``df`` as a version that no reader sees yet; returns its name.  The name ends with ``tag``, which becomes
    current together with the rows: a writer can tell from it what it has committed."""
    spark, table = df.sparkSession, table.rstrip("/")
    now = current(spark, table)
    number = int(now.rsplit("/", 1)[1].split("-")[0]) + 1 if now else 1
    name = f"{number:08d}-{uuid.uuid4().hex}" + (f"-{tag}" if tag else "")
    df.write.partitionBy(*partition_by).parquet(f"{table}/{VERSIONS}/{name}")
    return name


def publish(spark: SparkSession, table: str, name: str) -> None:
    """Make a written version the current one, in one step."""
    table = table.rstrip("/")
    store, pointer = _store(spark, table), f"{table}/{POINTER}"
    scheme = store.getUri().getScheme()

    def put(path: str) -> None:
        out = store.create(_path(spark, path), True)
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()

    if scheme in OBJECT_STORES:
        put(pointer)  # one request; the file is replaced when it is closed
        return
    jvm = spark.sparkContext._jvm
    new = f"{pointer}.{uuid.uuid4().hex}"
    if scheme == "file":
        files, args = jvm.java.nio.file.Files, spark.sparkContext._gateway.new_array(jvm.java.nio.file.CopyOption, 1)
        place = lambda p: jvm.java.io.File(_path(spark, p).toUri().getPath()).toPath()
        files.write(place(new), bytearray(name.encode()), spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
        args[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
        files.move(place(new), place(pointer), args)
        return
    put(new)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    args = spark.sparkContext._gateway.new_array(rename, 1)
    args[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        _path(spark, new), _path(spark, pointer), args)


def vacuum(spark: SparkSession, table: str, keep: int = 1) -> int:
    """Delete all versions but the current one and the ``keep`` published or written before it, and what a plain table
    has left; returns the number of deleted entries.  Not to be run beside a writer of the same table."""
    table = table.rstrip("/")
    now, store, n = current(spark, table), _store(spark, table), 0
    if now is None:
        return 0
    now = now.rsplit("/", 1)[1]
    found = sorted(s.getPath().getName() for s in store.listStatus(_path(spark, f"{table}/{VERSIONS}")))
    before = [v for v in found if int(v.split("-")[0]) < int(now.split("-")[0])]
    held = {now, *before[len(before) - keep:]} if keep else {now}
    for v in found:
        if v not in held:
            n += bool(store.delete(_path(spark, f"{table}/{VERSIONS}/{v}"), True))
    for s in store.listStatus(_path(spark, table)):
        if s.getPath().getName() not in (POINTER, VERSIONS):
            n += bool(store.delete(s.getPath(), True))
    return n


def replace_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), keep: int = 1) -> int:
    """Replace the table by ``df`` (which may read it); returns the rows written, counted from the new files' footers."""
    spark = df.sparkSession
    name = write_version(df, table, partition_by)
    n = spark.read.parquet(f"{table.rstrip('/')}/{VERSIONS}/{name}").count()
    publish(spark, table, name)
    vacuum(spark, table, keep)
    return n
