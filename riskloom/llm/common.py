"""Helpers the training-data operators share: Arrow buffers as numpy, shared-folder tables, repeat filters.

Conventions of every operator in this subpackage:

* ``doc_id`` names a document.  Rows that repeat both ``doc_id`` and text are one document and get the same
  answer on every row; a null ``doc_id`` is a valid key that sorts before all others.
* A null text is the empty text.  Columns an operator does not name are ignored (or, in pipeline stages, kept).
* An empty table gives an empty result with the same schema.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import checkpoint_dir, written

BUCKET_BITS = 16  # positions of the repeat filter travel as 16-bit offsets inside buckets of 65,536 bits


def prepare(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (a cluster may also get it by --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, which ``session.drop_materialised`` deletes with the others."""
    return written(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to the shared folder and reread: computed once, cheap to reread, safe from lost executors."""
    path = scratch(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty.  No Python object per row."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else pa.large_string()
    col = pc.fill_null(col.cast(wide), b"" if wide == pa.large_binary() else "")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def small(batches, rows: int = 512):
    """Arrow batches in slices of ``rows`` rows, which bounds what an operator copies of a batch at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0]..starts[0]+lens[0]-1, starts[1].., concatenated."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def mix64(h: np.ndarray) -> np.ndarray:
    """A finalising mixer for uint64 arrays."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class RepeatFilter:
    """Second Bloom filter of a two-pass scheme: bits that at least two rows set.

    ``build`` sets ``k`` positions per hash in a first filter and, where a position was set before, in a second
    one.  A hash that occurs twice has all its positions in the second filter, so ``test`` never misses a repeat;
    a false alarm only costs work.  It has 2**log2_bits bits; ``filter_bits`` gives the size for a number of hashes,
    and ``filter_slices`` deals more hashes than one filter holds into slices with a filter each.
    """

    def __init__(self, log2_bits: int = 27, k: int = 2):
        self.log2_bits, self.k = log2_bits, k
        self.words = None

    def positions(self, h: np.ndarray) -> list[np.ndarray]:
        h = mix64(h.view(np.uint64))
        out = []
        for i in range(self.k):
            out.append((h & np.uint64((1 << self.log2_bits) - 1)).astype(np.int64))
            h = mix64(h + np.uint64(0x9E3779B97F4A7C15))
        return out

    def build(self, hashes: DataFrame) -> "RepeatFilter":
        """``hashes``: one long column.  Shuffles 2 bytes per position; sends the fixed-size filter to the driver."""
        def spread(batches):
            held, size = [], 0
            for b in batches:
                h = np.asarray(b.column(0).drop_null()).astype(np.int64)
                held.append(h)
                size += len(h)
                if size > 2_000_000:
                    yield from emit(np.concatenate(held))
                    held, size = [], 0
            if size:
                yield from emit(np.concatenate(held))

        def emit(h):
            # twice says all there is to say of a position, so a hot hash is two entries of a worker's emission
            p, n = np.unique(np.concatenate(self.positions(h)), return_counts=True)
            p = np.repeat(p, np.minimum(n, 2))
            bucket = p >> BUCKET_BITS
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            low = (p & 0xFFFF).astype(np.uint16)
            packed = [x.tobytes() for x in np.split(low, cut[1:])]
            yield pa.record_batch([pa.array(bucket[cut].astype(np.int32)), pa.array(packed, pa.binary())],
                                  names=["bucket", "packed"])

        def merge(batches):
            once, twice = {}, {}
            for b in batches:
                for bucket, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    p = np.frombuffer(packed, np.uint16)
                    if bucket not in once:
                        once[bucket], twice[bucket] = np.zeros(65536, bool), np.zeros(65536, bool)
                    a, t = once[bucket], twice[bucket]
                    t[p[a[p]]] = True
                    t[p[1:][p[1:] == p[:-1]]] = True
                    a[p] = True
            keep = sorted(k for k, t in twice.items() if t.any())
            yield pa.record_batch([pa.array(keep, pa.int32()),
                                   pa.array([np.packbits(twice[k], bitorder="little").tobytes() for k in keep], pa.binary())],
                                  names=["bucket", "bits"])

        n = max(1, min(shuffle_width(hashes.sparkSession), 1 << (self.log2_bits - BUCKET_BITS)))
        rows = (hashes.mapInArrow(spread, "bucket int, packed binary").repartition(n, "bucket")
                .mapInArrow(merge, "bucket int, bits binary").toArrow())
        words = np.zeros((1 << (self.log2_bits - BUCKET_BITS), 8192), np.uint8)
        for bucket, bits in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            words[bucket] = np.frombuffer(bits, np.uint8)
        self.words = hashes.sparkSession.sparkContext.broadcast(words.reshape(-1))
        return self

    def test(self, h: np.ndarray) -> np.ndarray:
        words, hit = self.words.value, None
        for p in self.positions(h):
            x = ((words[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool)
            hit = x if hit is None else hit & x
        return hit

    def udf(self):
        """``test`` as a column function."""
        @F.pandas_udf("boolean")
        def possible(x: pd.Series) -> pd.Series:
            return pd.Series(self.test(x.to_numpy(np.int64)))

        return possible


FALSE_ALARM_BITS = 8  # bits a hash: under 5 % of unique hashes pass two positions
MAX_FILTER_BITS = 29  # 64 MiB, the largest filter that is broadcast


def filter_bits(hashes: int) -> int:
    """Size (log2 of bits) at which a filter with two positions lets under 5 % of so many unique hashes pass."""
    return min(MAX_FILTER_BITS, max(16, (max(1, hashes) * FALSE_ALARM_BITS - 1).bit_length()))


def filter_slices(hashes: int) -> int:
    """Slices (by hash) of which each fits the largest filter; one more than needed from two on, as slices vary."""
    n = -(-max(1, hashes) * FALSE_ALARM_BITS // (1 << MAX_FILTER_BITS))
    return n if n == 1 else n + 1


def probed(rows: DataFrame, hash_col: str, hashes: int, name: str, slices: int | None = None,
           log2_bits: int | None = None) -> DataFrame:
    """``rows``, written once, with a column ``possible``: false where the hash (a long column) certainly occurs once.

    ``hashes`` (an estimate of the rows) chooses the number of slices; each slice's filter is sized by its count (or
    ``log2_bits``).  A slice is a folder of the written table, so that every row is read once for the filters and once for the probe."""
    spark = rows.sparkSession
    slices = slices or filter_slices(hashes)
    path = scratch(spark, name)
    rows.withColumn("filter_slice", F.pmod(F.xxhash64(F.col(hash_col)), F.lit(slices)).cast("int")) \
        .write.partitionBy("filter_slice").parquet(path)
    out = None
    for k in range(slices):
        part = spark.read.schema(rows.schema).parquet(path + f"/filter_slice={k}") if has_folder(spark, path + f"/filter_slice={k}") else None
        if part is None:
            continue
        seen = RepeatFilter(log2_bits or filter_bits(part.count()), k=2).build(part.select(hash_col))
        part = part.withColumn("possible", seen.udf()(F.col(hash_col)))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], rows.schema.add("possible", "boolean"))


def slice_tables(rows: DataFrame, hash_col: str, slices: int, name: str, codec: str) -> list[DataFrame]:
    """``rows`` written once, as ``slices`` tables by a hash of ``hash_col`` (one table keeps the order of the rows)."""
    if slices == 1:
        return [materialise(rows, name, codec)]
    spark, path = rows.sparkSession, scratch(rows.sparkSession, name)
    rows.withColumn("filter_slice", F.pmod(F.xxhash64(F.col(hash_col)), F.lit(slices)).cast("int")) \
        .write.option("compression", codec).partitionBy("filter_slice").parquet(path)
    folders = [f"{path}/filter_slice={k}" for k in range(slices)]
    return [spark.read.schema(rows.schema).parquet(f) for f in folders if has_folder(spark, f)] or [spark.createDataFrame([], rows.schema)]


def has_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def sha256_hex(col):
    return F.sha2(F.coalesce(col, F.lit("")), 256)


BROADCAST_ROWS = 500_000


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", row_bytes: int = 64) -> DataFrame:
    """Join with a table written to the shared folder: broadcast if it is measured to be small, else a shuffled join
    whose hot keys adaptive execution splits.  ``row_bytes`` is an upper bound of a row of ``small``."""
    if small.limit(BROADCAST_ROWS * 64 // row_bytes + 1).count() <= BROADCAST_ROWS * 64 // row_bytes:
        small = F.broadcast(small)
    return big.join(small, on, how)
