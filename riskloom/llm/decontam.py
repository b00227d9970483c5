"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the benchmark's word windows, written as bytes with one space around every word.  Patterns of similar
length share a search table: a hash of the text's current block gives the safe shift; blocks that end some pattern's
head have shift 0 and lead, through the suffix-hash bucket, to the patterns to compare byte by byte.  Documents are
searched a batch at a time: many lanes over the batch's bytes advance together, each by its own shift.

The benchmark is the stated query set.  It is read in blocks of at most ``block_bytes`` of pattern text; each block's
tables are broadcast, so their size is bounded whatever the benchmark's size, and results of blocks are united.

Null or word-free texts have no words and no hits; word-free items have no windows; equal windows of several items
count for each of them.  Rows that repeat an item_id are texts of one item.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, materialise, ranges, small

RESULT = "doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<long>, text_key long"
HEADS = (24, 8, 3)  # patterns are searched in classes by these least lengths (" a " has 3 bytes)
BATCH = 2 << 20


def letter_table() -> np.ndarray:
    """Byte map: A-Z to a-z, 0-9, a-z and bytes of other scripts as they are, the rest to space."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    word = np.zeros(256, bool)
    for lo, hi in ((48, 57), (97, 122), (128, 255)):
        word[lo:hi + 1] = True
    return np.where(word[t], t, 32).astype(np.uint8)


LETTERS = letter_table()


def squeeze(data: np.ndarray, offs: np.ndarray):
    """Texts as ``\\0 w1 w2 .. wn `` each: bytes, start of each word's leading space, words before each text."""
    n = np.diff(offs)
    start = offs[:-1] + 3 * np.arange(len(n))
    body = np.full(len(data) + 3 * len(n), 32, np.uint8)
    body[ranges(start + 2, n)] = LETTERS[data]
    space = body == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]  # of a run of spaces the first stays
    # each text opens with a zero byte and a space, and ends with a space
    body[start] = 0
    keep[start], keep[start + 1] = True, True
    out, opens = body[keep], np.cumsum(keep) - 1
    is_space = out == 32
    # a space opens a word if a word byte follows it
    word_at = np.flatnonzero(is_space[:-1] & (out[1:] != 32) & (out[1:] != 0)) if len(out) else np.empty(0, np.int64)
    doc_at = opens[start]
    return out, word_at, np.searchsorted(word_at, np.append(doc_at, len(out)))


def item_windows(text: str | None, size: int) -> list[bytes]:
    """The distinct windows of an item as padded bytes: ``size`` consecutive words, or all of a shorter item."""
    words = LETTERS[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split()
    n = max(1, len(words) - size + 1) if words else 0
    return list(dict.fromkeys(b" " + b" ".join(words[i:i + size]) + b" " for i in range(n)))


class Table:
    """Shift and bucket tables of patterns that are at least ``head`` bytes long."""

    def __init__(self, patterns: list[tuple[int, bytes]], head: int):
        self.ids = np.array([i for i, _ in patterns], np.int64)
        texts = [p for _, p in patterns]
        self.len = np.fromiter(map(len, texts), np.int64, len(texts))
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.at = np.cumsum(self.len) - self.len
        self.m = int(self.len.min())  # the head: what all patterns of the class have
        self.block = min(8, head)
        reach = self.m - self.block + 1
        self.bits = max(12, min(22, int(np.ceil(np.log2(max(2, reach * len(texts) * 8))))))
        shift = np.full(1 << self.bits, reach, np.uint16)
        for back in range(reach - 1, -1, -1):  # block ending ``back`` bytes before the head's end
            h = self.hash(self.bytes, self.at + (self.m - self.block - back))
            shift[h] = np.minimum(shift[h], back)
        self.shift = shift
        end = self.hash(self.bytes, self.at + self.m - self.block)
        order = np.argsort(end, kind="stable")
        self.bucket, self.order = end[order], order

    def hash(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for k in range(self.block):
            h = (h << np.uint64(8)) | data[at + k]
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, data: np.ndarray, lane: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """All (position, pattern number) where a pattern occurs in ``data``."""
        last = len(data) - self.m
        if last < 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pos = np.arange(0, last + 1, lane, dtype=np.int64)  # candidate start of a head, one per lane
        stop = np.minimum(pos + lane, last + 1)
        found_at, found = [], []
        while len(pos):
            h = self.hash(data, pos + (self.m - self.block))
            step = self.shift[h].astype(np.int64)
            zero = step == 0
            if zero.any():
                at, hz = pos[zero], h[zero]
                lo, hi = np.searchsorted(self.bucket, hz), np.searchsorted(self.bucket, hz, side="right")
                n = hi - lo
                cand = self.order[ranges(lo, n)]
                a, c = self.compare(data, np.repeat(at, n), cand)
                found_at.append(a)
                found.append(c)
                step[zero] = 1
            pos = pos + step
            live = pos < stop
            pos, stop = pos[live], stop[live]
        if not found_at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)

    def compare(self, data, at, pat):
        """Keeps the candidates whose bytes all equal the pattern's."""
        ok = at + self.len[pat] <= len(data)
        at, pat = at[ok], pat[ok]
        k = 0
        live_at, live_pat, out_at, out_pat = at, pat, [], []
        while len(live_at):
            full = self.len[live_pat] == k
            out_at.append(live_at[full])
            out_pat.append(live_pat[full])
            live_at, live_pat = live_at[~full], live_pat[~full]
            if not len(live_at):
                break
            same = data[live_at + k] == self.bytes[self.at[live_pat] + k]
            live_at, live_pat, k = live_at[same], live_pat[same], k + 1
        return (np.concatenate(out_at), np.concatenate(out_pat)) if out_at else (at[:0], pat[:0])


class Patterns:
    """One benchmark block: distinct windows, the items that have them, and a table per length class."""

    def __init__(self, windows: dict[bytes, set]):
        texts = list(windows)
        owners = [sorted(windows[t]) for t in texts]
        self.items = np.array([x for o in owners for x in o], np.int64)
        self.n = np.fromiter(map(len, owners), np.int64, len(owners))
        self.at = np.cumsum(self.n) - self.n
        self.words = np.array([t.count(b" ") - 1 for t in texts], np.int64)
        classes: dict[int, list] = {}
        for i, t in enumerate(texts):
            classes.setdefault(next(h for h in HEADS if len(t) >= h), []).append((i, t))
        self.tables = [Table(p, h) for h, p in sorted(classes.items())]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int, block_bytes: int):
    """Windows of the benchmark, a bounded block at a time (the driver never holds more than one)."""
    windows, held = {}, 0
    for row in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        for w in item_windows(row["t"], size):
            if w not in windows:
                held += len(w)
            windows.setdefault(w, set()).add(-1 if row["i"] is None else row["i"])
        if held >= block_bytes:
            yield Patterns(windows)
            windows, held = {}, 0
    if windows:
        yield Patterns(windows)


def merge_spans(start: np.ndarray, end: np.ndarray) -> list[dict]:
    """Union of word intervals, as a list of disjoint ones."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    cut = np.flatnonzero(new)
    return [{"start": a, "end": b} for a, b in zip(start[cut].tolist(), reach[np.append(cut[1:], len(start)) - 1].tolist())]


def search_batch(data, offs, patterns: Patterns):
    """Per text: number of words, hit word intervals, items found."""
    body, word_at, before = squeeze(data, offs)
    n_words = np.diff(before)
    docs, start, end, item_docs, items = [], [], [], [], []
    for t in patterns.tables:
        at, pat = t.search(body)
        pat = t.ids[pat]
        w = np.searchsorted(word_at, at)
        d = np.searchsorted(before, w, side="right") - 1
        docs.append(d)
        start.append(w - before[d])
        end.append(w - before[d] + patterns.words[pat])
        item_docs.append(np.repeat(d, patterns.n[pat]))
        items.append(patterns.items[ranges(patterns.at[pat], patterns.n[pat])])
    spans, owners = [[] for _ in n_words], [[] for _ in n_words]
    if docs:
        docs, start, end, item_docs, items = map(np.concatenate, (docs, start, end, item_docs, items))
        order = np.argsort(docs, kind="stable")
        docs, start, end = docs[order], start[order], end[order]
        u, cut = np.unique(docs, return_index=True)
        for d, lo, hi in zip(u.tolist(), cut.tolist(), np.append(cut[1:], len(docs)).tolist()):
            spans[d] = merge_spans(start[lo:hi], end[lo:hi])
        pairs = np.unique(np.stack([item_docs, items]), axis=1)
        u, cut = np.unique(pairs[0], return_index=True)
        for d, lo, hi in zip(u.tolist(), cut.tolist(), np.append(cut[1:], pairs.shape[1]).tolist()):
            owners[d] = pairs[1][lo:hi].tolist()
    return n_words, spans, owners


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                       block_bytes: int = 16 << 20) -> DataFrame:
    """Per document: n_words, the disjoint hit word intervals [start, end) and the ids of the items that occur.

    A null item_id is reported as -1.  One benchmark block needs no shuffle at all; more blocks are searched one after
    another and their hits united per document.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.col(text_col)).alias("text_key"))

    def runner(shared):
        def run(batches):
            for b in small(batches):
                _, all_offs = column_bytes(b.column(1))
                i = 0
                while i < b.num_rows:
                    j = max(i + 1, int(np.searchsorted(all_offs, all_offs[i] + BATCH, side="right")) - 1)
                    data, offs = column_bytes(b.column(1).slice(i, j - i))
                    n, spans, items = search_batch(data, offs, shared.value)
                    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, j - i), pa.array(n), pa.array(spans, span_type),
                         pa.array(items, pa.list_(pa.int64())), b.column(2).slice(i, j - i)],
                        names=["doc_id", "n_words", "spans", "items", "text_key"])
                    i = j
        return run

    found = [src.mapInArrow(runner(sc.broadcast(p)), RESULT)
             for p in blocks(benchmark, item_col, item_text, window, block_bytes) or []]
    if not found:
        found = [src.mapInArrow(runner(sc.broadcast(Patterns({}))), RESULT)]
    if len(found) == 1:
        return found[0]
    # hits of several blocks: one small row per document with hits and block
    out, united = found[0].select("doc_id", "n_words", "text_key"), None
    for f in found:
        hits = materialise(f.where(F.size("items") > 0).select("doc_id", "text_key", "spans", "items").distinct(), "hits")
        united = hits if united is None else united.unionByName(hits)
    parts = united.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).agg(
        F.flatten(F.collect_list("spans")).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    step = F.aggregate(F.array_sort("s"), F.array().cast("array<struct<start:int,end:int>>"), lambda a, x: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= x["start"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(a, F.array(x))))
    parts = parts.select("d", "k", "items", step.alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return out.join(parts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left").select(
        "doc_id", "n_words", F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), "text_key")


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Counts and digests per document, from the spans."""
    s = contaminated_spans(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return s.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
