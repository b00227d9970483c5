"""Periodic stretches of words by Baier grouping: Lyndon words of every position, extended to runs.

Phase one of Baier's suffix sorter groups the suffixes of a word sequence by their longest Lyndon prefix, so the size
of a suffix's last group context is its Lyndon array entry; no suffix array is finished.  It is run under the word
order and under the reversed order.  Every run (maximal repetition) has a Lyndon root that one of the two arrays
names; extending each named root by the longest common extensions to both sides, read from prefix-doubling ranks (no
hashing), gives the runs exactly.

Before that a document is cut at words that cannot lie in a run: inside a run of ``min_exponent`` periods every word
occurs at least that often, so a stretch is split at rarer words until nothing changes.  Prose vanishes in this step.

Nothing is shuffled; a worker holds one batch of about 1 MB of text, or one longer document.  A null text has no
words.  Repeated rows are treated alike; extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import groups
from .common import small

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lyndon_array(sym: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position: phase one of Baier's suffix sorter.

    Groups of suffixes with the same context are visited from the highest to the lowest.  Each suffix of the visited
    group points to the nearest suffix before it in a lower group; suffixes pointed to ``l`` times have their context
    extended by ``l`` contexts of the visited group and form a new group right above their old one.
    """
    n = len(sym)
    letters = {c: g for g, c in enumerate(sorted(set(sym)))}
    group = [0, *[letters[c] for c in sym]]  # positions count from 1; 0 stands for "none before"
    members: list[list[int]] = [[] for _ in letters]
    for i in range(1, n + 1):
        members[group[i]].append(i)
    size = [1] * len(letters)
    below = list(range(-1, len(letters) - 1))
    above = [*range(1, len(letters)), -1]
    lower = list(range(n + 1))  # union-find: the nearest position to the left that is not yet visited
    g = len(letters) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in own:
            lower[i] = i - 1
        times: dict[int, int] = {}
        for i in own:
            x = i
            while lower[x] != x:
                lower[x] = lower[lower[x]]
                x = lower[x]
            if x:
                times[x] = times.get(x, 0) + 1
        if times:
            moved: dict[tuple[int, int], list[int]] = {}
            for x, k in times.items():
                moved.setdefault((k, group[x]), []).append(x)
            for k, old in sorted(moved, reverse=True):
                new = len(size)
                size.append(size[old] + k * size[g])
                members.append(moved[k, old])
                for x in members[new]:
                    group[x] = new
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                below[up] = new  # ``up`` exists: the visited group lies above every lower one
        g = below[g]
    return [size[x] for x in group[1:]]


def stretches(word: np.ndarray, part: np.ndarray, times: int, least: int) -> list[np.ndarray]:
    """Position arrays of the stretches that may hold a run: every word at least ``times`` times, ``least`` words or more."""
    at = np.arange(len(word))
    while len(at):
        _, back, n = np.unique(part * (word.max() + 1) + word, return_inverse=True, return_counts=True)
        ok = n[back] >= times
        at_ok, part_ok = at[ok], part[ok]
        new = np.r_[True, (at_ok[1:] != at_ok[:-1] + 1) | (part_ok[1:] != part_ok[:-1])] if len(at_ok) else np.empty(0, bool)
        which = np.cumsum(new) - 1
        long_ = np.bincount(which)[which] >= least if len(which) else np.empty(0, bool)
        settled = ok.all() and long_.all()
        at, part, word = at_ok[long_], which[long_], word[ok][long_]
        if settled:
            break
    return np.split(at, np.flatnonzero(part[1:] != part[:-1]) + 1) if len(at) else []


class Extensions:
    """Longest common extensions inside stretches: ranks of all substrings of 1, 2, 4, ... words, by prefix doubling."""

    def __init__(self, seq: np.ndarray, longest: int):
        self.ranks = [np.unique(seq, return_inverse=True)[1]]
        while 2 << (len(self.ranks) - 1) <= longest:
            r, step = self.ranks[-1], 1 << (len(self.ranks) - 1)
            self.ranks.append(np.unique(r[:-step] * (int(r.max()) + 1) + r[step:], return_inverse=True)[1].astype(np.int32).astype(np.int64)
                              if len(r) > step else r[:0])

    def forward(self, a, b):
        ext = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r = self.ranks[k]
            y = b + ext
            ok = y < len(r)
            ok[ok] = r[(a + ext)[ok]] == r[y[ok]]
            ext += ok.astype(np.int64) << k
        return ext

    def backward(self, a, b):
        """Common suffix length of the texts that end before ``a`` and before ``b`` (``a`` < ``b``)."""
        ext = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            r = self.ranks[k]
            x, y = a - ext - (1 << k), b - ext - (1 << k)
            ok = (x >= 0) & (y < len(r))
            ok[ok] = r[x[ok]] == r[y[ok]]
            ext += ok.astype(np.int64) << k
        return ext


def runs_of(docs: list[list], min_length: int = 6, min_exponent: int = 4) -> list[np.ndarray]:
    """For each word list its runs as rows (start, length, period), by start, then period."""
    index: dict = {}
    ids = [[index.setdefault(w, len(index)) for w in ws] for ws in docs]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    first = np.cumsum(sizes) - sizes
    word = np.fromiter((w for ws in ids for w in ws), np.int64, int(sizes.sum()))
    parts = stretches(word, np.repeat(np.arange(len(ids)), sizes), min_exponent, min_length)
    empty = np.empty((0, 3), np.int64)
    if not parts:
        return [empty] * len(docs)
    # the stretches one after another, each closed by a symbol of its own
    seq, begins = [], []
    at, fresh = 0, len(index)
    for k, p in enumerate(parts):
        begins.append(at)
        seq += [word[p], [fresh + k]]
        at += len(p) + 1
    lce = Extensions(np.concatenate(seq), max(map(len, parts)))
    starts, periods = [], []
    for begin, p in zip(begins, parts):
        sym = word[p].tolist()
        for s in (sym, [-c for c in sym]):
            root = np.array(lyndon_array(s), np.int64)
            i = np.flatnonzero(root * min_exponent <= len(sym))
            starts.append(begin + i)
            periods.append(root[i])
    i, q = np.concatenate(starts), np.concatenate(periods)
    left, right = lce.backward(i, i + q), lce.forward(i, i + q)
    length = left + right + q
    ok = length >= np.maximum(min_length, min_exponent * q)
    found = np.unique(np.stack([i[ok] - left[ok], q[ok], length[ok]], 1), axis=0)
    if not len(found):
        return [empty] * len(docs)
    begins = np.array(begins)
    part = np.searchsorted(begins, found[:, 0], side="right") - 1
    place = np.array([p[0] for p in parts])[part] + found[:, 0] - begins[part]
    doc = np.searchsorted(first + sizes, place, side="right")
    rows = np.stack([place - first[doc], found[:, 2], found[:, 1]], 1)
    ends = np.searchsorted(doc, np.arange(1, len(docs)))
    return np.split(rows, ends)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, each run cut down to its first period."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """One row per input row: doc_id, ``runs`` (array of start, length, period, in words) and ``collapsed`` (the text's
    words joined by single spaces, of each run only the first period).  Words are stretches without ASCII white space;
    a run has ``min_length`` words and ``min_exponent`` periods or more and no neighbouring word extends it."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, collapsed string"

    def run(batches):
        for b in small(batches):
            for i, j in groups(b.column(1)):
                words = [(x or b"").split() for x in b.column(1)[i:j].cast(pa.binary()).to_pylist()]
                found = runs_of(words, min_length, min_exponent)
                flat = np.concatenate(found)
                offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                texts = pa.array([collapsed(w, r) for w, r in zip(words, found)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.ListArray.from_arrays(offsets, items), texts],
                                                 names=["doc_id", "runs", "collapsed"])

    return src.mapInArrow(run, schema)


def with_planted_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and texts of ``docs``; one document of ten (by the crc32 of its id) goes on periodically from some word on.

    DataFrame functions; texts of the other documents, and of those without an id or a word, pass unchanged.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # a column per step: each is read several times below
    out = docs.select(F.col(id_col), F.col(text_col), h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    out = out.withColumn("n", F.nullif(F.size("w"), F.lit(0))).withColumn("g", F.floor(F.col("h") / 10))
    out = out.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    out = out.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a = F.col("a")
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", F.when(i >= a, a + (i - a) % F.col("p")).otherwise(i)))
    return out.select(F.col(id_col), F.when(F.col("n").isNotNull(), F.concat_ws(" ", again)).otherwise(F.col(text_col)).alias(text_col))
