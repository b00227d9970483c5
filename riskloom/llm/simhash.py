"""SimHash near-duplicate components by deletion-variant signatures.

A fingerprint has a bit for each of the 64 positions that more than half of a text's shingle hashes set.  Two
fingerprints that differ in at most two bits are cut into two halves, of which one differs by at most one bit.  Each
half is therefore indexed whole and with each of its bits replaced by a wildcard; fingerprints that share such a
variant meet in one group (an equality join on the variant) and the links are verified on all 64 bits there:

* group of a whole half: the other halves may differ in two bits;
* group with a wildcard: only pairs that differ in that very bit count, and their other halves may differ in one.

So each link is found in at most two groups.  Equal fingerprints are one node from the start.  Small groups compare
neighbours directly; a large one masks the bits a link may differ in, sorts, and ties equal neighbours, and hands on a
spanning forest, so no group emits its pairs and links between distinct texts are all kept.

Null and word-free texts have fingerprint zero and link like any other.  Repeated ids are one node of the graph.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_width, small
from .graph import components

SEED = 42
SMALL_GROUP = 16


def shingle_hashes(text: str | None, size: int = 3):
    """XXH64 of the text's word shingles in arrays of bounded length."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, and only ASCII blanks part words
    if not words:
        return
    if len(words) < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    lo, hi = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    h = xxhash.xxh64_intdigest
    for i in range(0, len(lo), 1 << 16):
        part = [h(body[a:b], SEED) for a, b in zip(lo[i:i + (1 << 16)], hi[i:i + (1 << 16)])]
        yield np.array(part, np.uint64)


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash as an unsigned number."""
    n, ones = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(text, size):
        n += len(h)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long)."""
    def run(batches):
        for b in small(batches):
            fp = np.array([fingerprint(t.as_py(), size) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """Index rows (slot, part, fp): slot 0..65 names the half and the wildcard bit (32: none), part the remaining bits."""
    def half(i):
        return F.shiftrightunsigned("fp", 32) if i else F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))

    parts = [F.struct(F.lit(33 * i + j).alias("slot"),
                      half(i).bitwiseAND(F.lit(((1 << 32) - 1) ^ (1 << j if j < 32 else 0))).alias("part"))
             for i in (0, 1) for j in range(33)]
    return fps.select("fp", F.explode(F.array(*parts)).alias("v")).select("v.slot", "v.part", "fp")


def far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64))


def pair_links(fp, slot, group_len, start, limit):
    """Verified links inside groups of at most SMALL_GROUP rows; row i meets rows i+1, i+2, .. of its own group."""
    out = []
    ends = np.repeat(start + group_len, group_len)
    rows = np.concatenate([np.arange(s, s + n) for s, n in zip(start, group_len)]) if len(start) else np.empty(0, np.int64)
    for d in range(1, SMALL_GROUP):
        ok = rows + d < ends
        rows, ends = rows[ok], ends[ok]
        if not len(rows):
            break
        x, y = fp[rows], fp[rows + d]
        link = far(x, y) <= limit
        j = slot[rows].astype(np.int64)
        bit = np.where(j >= 33, j - 1, j)  # of the 64-bit word, where the slot has a wildcard
        wild = (j % 33) != 32
        differs = (((x ^ y).view(np.uint64) >> np.where(wild, bit, 0).astype(np.uint64)) & np.uint64(1)) == 1
        link &= ~wild | differs
        out.append((x[link], y[link]))
    return out


def forest(fp: np.ndarray, slot: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one large group, as (fingerprint, root) pairs."""
    fp = np.unique(fp)
    root = np.arange(len(fp))
    i, j = divmod(int(slot), 33)
    other = range(0, 32) if i else range(32, 64)
    one = [np.uint64(1) << np.uint64(k) for k in range(64)]
    if j == 32:
        masks = [one[p] | one[q] for p, q in combinations(other, 2)]
    else:  # pairs that differ in the wildcard bit; the other half in one more at most
        masks = [one[32 * i + j] | one[q] for q in other]
    u = fp.view(np.uint64)
    for m in masks:
        code = u & ~m
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        a, b = order[:-1][same], order[1:][same]
        while len(a):
            x, y = root[a], root[b]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            open_ = lo != hi
            if not open_.any():
                break
            np.minimum.at(root, hi[open_], lo[open_])
            while True:  # shorten paths
                deeper = root[root]
                if (deeper == root).all():
                    break
                root = deeper
    moved = root != np.arange(len(fp))
    return fp[moved], fp[root[moved]]


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ in one or two bits, enough to join every component."""
    def run(batches):
        held = None
        for b in batches:
            cols = [np.asarray(b.column(i)) for i in range(3)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            slot, part, fp = cols
            if not len(fp):
                continue
            cut = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (part[1:] != part[:-1])])
            # the last group may go on in the next batch
            held = [c[cut[-1]:] for c in cols]
            yield from emit(slot, fp, cut)
        if held is not None:
            yield from emit(held[0], held[2], np.array([0, len(held[2])]))

    def emit(slot, fp, cut):
        n, start = np.diff(cut), cut[:-1]
        small = (n > 1) & (n <= SMALL_GROUP)
        found = pair_links(fp, slot, n[small], start[small], 2)
        for s, k in zip(start[n > SMALL_GROUP].tolist(), n[n > SMALL_GROUP].tolist()):
            found.append(forest(fp[s:s + k], slot[s]))
        if found:
            x, y = (np.concatenate(c) for c in zip(*found))
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            u = np.unique(np.stack([lo, hi]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(u[0]), pa.array(u[1])], names=["a", "b"])

    n = shuffle_width(fps.sparkSession)
    dealt = variants(fps).repartition(n, "slot", "part").sortWithinPartitions("slot", "part")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def simhash_components(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp, component_id (smallest id of its component)."""
    prints = materialise(fingerprints(docs, size, id_col, text_col), "fingerprints")
    # copies of a fingerprint are one node; map-side minima keep a hot one small
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes.select("fp"))).select(F.col("node").alias("fp"), "root")
    linked = materialise(found.join(nodes, "fp"), "members")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    ids = linked.join(least, "root").select("fp", "least")
    # one row per fingerprint with its component's smallest id
    named = materialise(nodes.join(ids, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
