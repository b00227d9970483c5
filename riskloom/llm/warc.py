"""Dictionary-compressed WARC archives: writer and reader.

Layout of an archive ``*.warc.zst``: a leading skippable frame (magic 0x184D2A5D) holds a Zstandard dictionary built
from the records of that archive, then every record is one Zstandard frame compressed with it.  Each record stays
readable by itself once the dictionary is known.

Among pages with equal payloads of at least ``min_revisit`` bytes the smallest page_id is stored as ``response`` and
the others as ``revisit`` records that carry only headers.  Archives go to a folder of a shared file system (any
address pyarrow's file systems know); a retried task rewrites the same names with the same bytes, through a temporary
name and a rename, so a lost executor leaves no half archive behind.

Null html is an empty payload, a null url becomes ``about:blank``, a null page_id is written without the id header (and reads
back null; it sorts before all ids, so it is the response of its group).  Rows that repeat id and payload are written
one record each, all responses or all revisits alike.  Empty tables leave no archive.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, scratch

MAGIC = 0x184D2A5D
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_id(page_id, salt: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}{salt}')}>"


def make_record(page_id, url, payload: bytes | None, n: int, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; ``payload`` None writes a revisit."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n
    revisit = payload is None
    block = head if revisit else head + payload
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
             b"WARC-Record-ID: " + record_id(page_id).encode(), b"WARC-Date: " + date.encode(),
             # a header is one line; a control byte in a url cannot open another
             b"WARC-Target-URI: " + "".join(c if c >= " " else "%%%02X" % ord(c) for c in url or "about:blank").encode(),
             b"WARC-Payload-Digest: sha256:" + digest.encode(), b"WARC-Payload-Length: %d" % n,
             b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    if page_id is not None:
        lines.append(b"WARC-Page-ID: %d" % page_id)
    if revisit:
        lines.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(b"WARC-Refers-To: " + record_id(refers_to).encode())
        if refers_to is not None:
            lines.append(b"WARC-Refers-To-Page-ID: %d" % refers_to)
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int) -> bytes:
    """Trained on all records of the archive; where the trainer has too few, their first bytes serve as content."""
    try:
        return zstandard.train_dictionary(size, records, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:size]


def encode_archive(records: list[bytes], dict_size: int, level: int) -> bytes:
    raw = build_dictionary(records, dict_size)
    z = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
    return b"".join([struct.pack("<II", MAGIC, len(raw)), raw, *(z.compress(r) for r in records)])


def decode_archive(data: bytes):
    """The records of an archive, one after another; raises on a damaged one."""
    magic, n = struct.unpack_from("<II", data)
    if magic != MAGIC:
        raise ValueError("no dictionary frame at the start")
    z = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + n]))
    view, at = memoryview(data), 8 + n
    while at < len(data):
        d = z.decompressobj()
        step, out = 1 << 16, []
        while not d.eof:
            piece = view[at:at + step]
            if not piece:
                raise ValueError("an archive ends inside a record")
            out.append(d.decompress(piece))
            at += len(piece)
        at -= len(d.unused_data)
        yield b"".join(out)


def parse_record(rec: bytes) -> tuple[dict, bytes]:
    head, _, rest = rec.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:]), rest


def plan_records(pages: DataFrame, min_revisit: int) -> DataFrame:
    """Page rows with digest, record type and target; html is dropped from revisits."""
    base = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html")) \
        .withColumn("digest", F.sha2("html", 256)).withColumn("n", F.octet_length("html").cast("long"))
    long = base.where(F.col("n") >= min_revisit)
    firsts = long.groupBy("digest").agg(F.count("*").alias("copies"), F.min("page_id").alias("first"),
                                        F.count_if(F.col("page_id").isNull()).alias("nulls")) \
        .where("copies > 1").select("digest", F.when(F.col("nulls") > 0, F.lit(None)).otherwise(F.col("first")).alias("first"),
                                    F.lit(True).alias("grouped"))
    # only digests, not pages, decide; each page row then meets at most one row of the table of repeated digests
    out = base.join(materialise(firsts, "warc-groups"), "digest", "left")
    revisit = F.coalesce(F.col("grouped"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "digest", "n", F.when(~revisit, F.col("html")).alias("html"),
                      F.when(revisit, F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, min_revisit: int = 100, archive_bytes: int = 24 << 20,
               dict_size: int = 64 << 10, level: int = 3, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives under ``folder`` (an absolute address on a shared file system).

    Returns one row per archive: name, records, raw_bytes, stored_bytes.  An archive is closed at ``archive_bytes`` of raw records,
    which bounds a task's memory; the dictionary is built from all records of its archive.
    """
    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        ctx = TaskContext.get()
        held, size, part = [], 0, 0

        def close():
            nonlocal held, size, part
            name = f"part-{ctx.partitionId():05d}-{part:05d}.warc.zst"
            data = encode_archive(held, dict_size, level)
            # the hidden name is this attempt's own; an earlier attempt has left the same bytes or nothing
            temp, final = posixpath.join(root, f"_{name}.{ctx.taskAttemptId()}"), posixpath.join(root, name)
            with store.open_output_stream(temp) as f:
                f.write(data)
            if store.get_file_info(final).size == len(data):
                store.delete_file(temp)
            else:
                store.move(temp, final)
            row = (name, len(held), size, len(data))
            held, size, part = [], 0, part + 1
            return pa.record_batch([pa.array([x]) for x in row], names=["name", "records", "raw_bytes", "stored_bytes"])

        for b in batches:
            for page_id, url, digest, n, html, refers in zip(*(b.column(i).to_pylist() for i in range(6))):
                rec = make_record(page_id, url, None if html is None else html.encode(), n, digest, refers, date)
                held.append(rec)
                size += len(rec)
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    # the records stay where the join put them (pages move once at most); their fixed order inside a partition lets a
    # retried task write the same archives
    placed = plan_records(pages, min_revisit).sortWithinPartitions("page_id", "url", "digest")
    return placed.mapInArrow(write, "name string, records long, raw_bytes long, stored_bytes long")


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives in ``folder``; response payloads are checked against their digest and length."""
    def read(batches):
        for b in batches:
            for data in b.column(0):
                rows = []
                size = 0
                for rec in decode_archive(data.as_py()):
                    h, block = parse_record(rec)
                    block = block[:int(h["Content-Length"])]
                    digest, n = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["WARC-Payload-Length"])
                    payload = None
                    if h["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if len(payload) != n or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"record {h['WARC-Record-ID']} does not match its digest")
                    rows.append((h.get("WARC-Page-ID"), n, digest, h["WARC-Type"], h.get("WARC-Refers-To-Page-ID"),
                                 payload if with_payload else None))
                    size += len(rec) if with_payload else 200
                    if size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows):
        c = list(zip(*rows))
        as_long = lambda x: pa.array([None if v is None else int(v) for v in x], pa.int64())
        return pa.record_batch([as_long(c[0]), pa.array(c[1], pa.int64()), pa.array(c[2]), pa.array(c[3]), as_long(c[4]),
                                pa.array(c[5], pa.binary())],
                               names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.zst").load(folder)
    return files.select("content").mapInArrow(read, READ_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, then read every archive back."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder
    written = materialise(write_warc(pages, folder), "warc-manifest")
    if written.isEmpty():
        return spark.createDataFrame([], READ_SCHEMA).drop("payload")
    return read_warc(spark, folder, with_payload=False).drop("payload")
