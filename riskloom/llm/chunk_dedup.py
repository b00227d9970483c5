"""Substring deduplication by content-defined chunks with a gear rolling hash.

A chunk ends where the top ``bits`` bits of the gear hash of the last 32 bytes are zero, between ``min_size`` and
``max_size`` bytes and never inside a character.  Boundaries depend on the bytes before them alone, so they fall into
step again after an insertion.  Chunks with equal digests (XXH3, 128 bits) are one; all but the first occurrence (smallest
doc_id, then position) are repeats.  A run of adjacent repeats of ``min_run`` bytes or more is removed; shorter runs
are common turns of phrase and stay.

A filter of repeated digests (``RepeatFilter``, sized by the number of chunks, in slices by digest where one filter would be
too large to broadcast) keeps 95 % or more of the chunks that occur once out of the shuffle, at any size.

Null texts count as empty and have no chunks; a text that loses everything stays as an empty text.  Rows that repeat
doc_id and text are one document.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, materialise, mix64, probed, small

MIN_SIZE, BITS, MAX_SIZE, MIN_RUN = 32, 5, 512, 100
PIECE = 4 << 20
GEAR = (mix64(mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(32)).astype(np.uint32)


def gear_hash(b: np.ndarray) -> np.ndarray:
    """Gear hash after each byte over the 32 bytes up to it: a byte's table value is shifted out after 32 steps."""
    h = GEAR[b]
    for s in (1, 2, 4, 8, 16):
        if len(h) > s:
            h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    return h


def chunk_ends(raw: np.ndarray, min_size: int = MIN_SIZE, bits: int = BITS, max_size: int = MAX_SIZE) -> list[int]:
    """End offsets of the chunks of one text."""
    n, cand = len(raw), []
    for s in range(0, n, PIECE):
        back = min(s, 31)
        h = gear_hash(raw[s - back:s + PIECE])[back:]
        end = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + s + 1
        end = end[end < n]
        cand.append(end[(raw[end] & 0xC0) != 0x80])
    ends, start = [], 0

    def force(upto):
        nonlocal start
        while upto - start > max_size:
            cut = start + max_size
            while (raw[cut] & 0xC0) == 0x80 and cut > start + 1:
                cut -= 1
            ends.append(cut)
            start = cut

    for e in (np.concatenate(cand).tolist() if cand else []):
        force(e)
        if e - start >= min_size:
            ends.append(e)
            start = e
    force(n)
    if start < n:
        ends.append(n)
    return ends


def chunk_table(docs: DataFrame, **sizes) -> DataFrame:
    """All chunks: digest halves d1 and d2, doc_id, text_key, start, size."""
    def run(batches):
        for b in small(batches):
            data, offs = column_bytes(b.column(1))
            ids, keys = b.column(0).to_pylist(), b.column(2).to_pylist()
            whole, parts, held = data.tobytes(), [], 0
            for i, (doc, key) in enumerate(zip(ids, keys)):
                raw = data[offs[i]:offs[i + 1]]
                ends = chunk_ends(raw, **sizes)
                if not ends:
                    continue
                starts = [0, *ends[:-1]]
                at = int(offs[i])
                d = np.frombuffer(b"".join([xxhash.xxh3_128_digest(whole[at + s:at + e]) for s, e in zip(starts, ends)]), np.int64).reshape(-1, 2)
                starts, ends = np.array(starts, np.int32), np.array(ends, np.int32)
                parts.append((d[:, 0], d[:, 1], [doc] * len(d), np.full(len(d), key, np.int64), starts, ends - starts))
                held += len(d)
                if held > 100_000:
                    yield batch(parts)
                    parts, held = [], 0
            if parts:
                yield batch(parts)

    def batch(parts):
        c = list(zip(*parts))
        flat = [np.concatenate(x) if i != 2 else pa.array([y for z in x for y in z], pa.int64()) for i, x in enumerate(c)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in flat], names=["d1", "d2", "doc_id", "text_key", "start", "size"])

    return docs.mapInArrow(run, "d1 long, d2 long, doc_id long, text_key long, start int, size int")


def merge_runs(spans: list, min_run: int) -> list[tuple[int, int]]:
    """Adjacent (start, size) spans as (start, end) runs of at least ``min_run`` bytes."""
    out = []
    for s, n in sorted(spans):
        if out and out[-1][1] == s:
            out[-1][1] = s + n
        else:
            out.append([s, s + n])
    return [(a, b) for a, b in out if b - a >= min_run]


def repeated_spans(docs: DataFrame, slices: int | None, log2_bits: int | None, **sizes) -> DataFrame:
    """(doc_id, text_key, spans) of the documents with repeated chunks."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = probed(chunk_table(docs, **sizes), "d1", size // (sizes["min_size"] + (1 << sizes["bits"])), "chunks", slices, log2_bits).where("possible").drop("possible")
    place = F.struct("doc_id", "start", "text_key")
    groups = chunks.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    groups = materialise(groups.select("d1", "d2", "first"), "chunk-groups")
    later = chunks.join(groups, ["d1", "d2"]).where(place != F.col("first"))
    return materialise(later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "size")).alias("spans")), "chunk-spans")


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN, slices: int | None = None, log2_bits: int | None = None,
                min_size: int = MIN_SIZE, bits: int = BITS, max_size: int = MAX_SIZE) -> DataFrame:
    """One row per input row: doc_id, kept text, n_bytes, n_removed, n_spans."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    spans = repeated_spans(src, slices, log2_bits, min_size=min_size, bits=bits, max_size=max_size)
    spans = spans.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "spans")
    # spans grow with the documents, so this is a shuffled join at every size
    rows = src.join(spans.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")

    def run(batches):
        for b in small(batches):
            texts, out = b.column(1).to_pylist(), []
            for t, found in zip(texts, b.column(2).to_pylist()):
                raw = t.encode()
                runs = merge_runs([(s["start"], s["size"]) for s in found], min_run) if found else []
                kept, at = [], 0
                for a, e in runs:
                    kept.append(raw[at:a])
                    at = e
                kept.append(raw[at:])
                kept = b"".join(kept)
                out.append((kept.decode(), len(raw), len(raw) - len(kept), len(runs)))
            c = list(zip(*out))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c[0], pa.string()), *(pa.array(x, pa.int64()) for x in c[1:])],
                                             names=["doc_id", "text", "n_bytes", "n_removed", "n_spans"])

    return rows.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, text string, n_bytes long, n_removed long, n_spans long")
