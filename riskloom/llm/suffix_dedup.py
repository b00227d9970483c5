"""Removal of repeated byte strings by suffix arrays.

Every ``length``-byte string that starts earlier elsewhere (smaller doc_id, or same document and smaller offset) marks
its bytes for removal.  All starts are judged on the input.

1. Each start's key is the least hash of the 32-byte strings inside its ``length`` bytes: equal strings have equal keys.
   A filter of repeated keys (``RepeatFilter``) leaves only text that may repeat.  It is probed while the text is read, so it
   is one filter of at most 2**``log2_bits`` bits; beyond some 50 million keys more and more unique text passes it to
   step 2, which writes it but does not shuffle it.
2. That text is cut into shards.  A shard's suffix array is built by Larsson-Sadakane refinement (packed 8-byte prefixes,
   then doubling over the groups that are still tied), Kasai's walk gives the common prefixes, and runs of prefixes of
   ``length`` or more are the shard's repeats.  Only a shard's first occurrences go on, and of those only the ones whose key
   a second filter has seen in two of them.  It is sized by their number, in slices by key beyond the largest filter.
3. First occurrences meet by key.  The strings of the shards that meet there are merged: sorted fingerprints, each
   string finds the earliest of its kind by binary search, and its bytes are compared.  Keys that fill more than half a
   block are hot: their strings are dealt on by a 128-bit fingerprint of the whole string, which stands for its bytes.

4. A filter over the documents with repeats tells which rows need the join with the spans; the text of the others is not
   shuffled.  Beyond 67 million such documents more and more of the others take the join too, with the same result.

Null text counts as empty.  Rows that repeat doc_id and text are one document; different texts of one doc_id are separate
documents in the order of their text hash.  A null doc_id comes first.  Texts shorter than ``length`` keep all bytes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    RepeatFilter, column_bytes, filter_bits, filter_slices, join_checked, materialise, mix64, ranges, shuffle_width, slice_tables, small,
)

GRAM = 32
GROUP_BYTES = 1 << 17  # text whose keys are computed together, a few arrays of which fit a core's cache
SHARD_BYTES = 1 << 20  # text of a suffix array
BLOCK_BYTES = 1 << 20  # text merged together across shards
NO_ID = np.iinfo(np.int64).min
SPANS = "doc_id long, text_key long, start long, stop long"
PARTS = "key long, doc_id long, text_key long, start long, stop long, body binary"
REPEAT = 0  # the key of a shard's repeats, which no string has
PLACE = np.uint64((1 << 21) - 1)  # low bits of a hash that hold its place in a group of texts
_BYTE = mix64(mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def string_hash(b: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the ``n`` bytes from every position, built from halves."""
    h, size, acc, done = _BYTE[b], 1, None, 0
    while True:
        if n & size:
            if acc is None:
                acc = h
            else:
                m = len(h) - done
                acc = mix64(acc[:m] * np.uint64(0xBF58476D1CE4E5B9) + h[done:])
            done += size
        if done == n:
            return acc
        h = h[:-size] * np.uint64(0x94D049BB133111EB) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2


def string_keys(b: np.ndarray, length: int) -> np.ndarray:
    """The least 32-byte hash in the string of ``length`` bytes at every position (a sliding minimum), with the place where
    it stands in the low bits: of equal hashes the first counts.  ``key | PLACE`` is the string's key."""
    m, size, width = mix64(string_hash(b, GRAM)), 1, length - GRAM + 1
    m &= ~PLACE
    m |= np.arange(len(m), dtype=np.uint64)
    for step in iter(lambda: min(size, width - size), 0):
        m = np.minimum(m[:-step], m[step:])
        size += step
    return m


def text_groups(batch, length: int):
    """Bounded groups of texts: doc ids, text keys, base offsets, bytes, starts, text and ``string_keys`` of each start.

    A text longer than a group is read in pieces that overlap by ``length`` - 1 bytes; each piece is a text of its own
    here, with its base offset.
    """
    ids = np.array([NO_ID if x is None else x for x in batch.column(0).to_pylist()], np.int64)
    keys = batch.column(2).to_numpy()
    data, offs = column_bytes(batch.column(1))
    rows, lo, hi, base = [], [], [], []
    for i in range(len(ids)):
        for s in range(0, max(0, int(offs[i + 1] - offs[i]) - length + 1), GROUP_BYTES):
            rows.append(i)
            base.append(s)
            lo.append(offs[i] + s)
            hi.append(min(offs[i + 1], offs[i] + s + GROUP_BYTES + length - 1))
    rows, lo, hi, base = (np.array(x, np.int64) for x in (rows, lo, hi, base))
    n = hi - lo
    at, total = 0, np.cumsum(n)
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + GROUP_BYTES, side="right")))
        part = slice(at, end)
        b = data[ranges(lo[part], n[part])]
        first = np.cumsum(n[part]) - n[part]
        starts = ranges(first, n[part] - length + 1)
        owner = np.repeat(np.arange(end - at), n[part] - length + 1)
        yield ids[rows[part]], keys[rows[part]], base[part] - first, b, starts, owner, string_keys(b, length)[starts]
        at = end


# -- suffix arrays ----------------------------------------------------------------------------------------------------
def packed_words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as a big-endian number; zeros follow the end."""
    t = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    w = t[:-1] << np.uint64(8) | t[1:]
    w = w[:-2] << np.uint64(16) | w[2:]
    return (w[:-4] << np.uint64(32) | w[4:])[:len(text)]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, to at least ``depth`` bytes (ties beyond in any order).

    ``rank[p]`` is the number of the first place of p's group, so a group that becomes single has its final place and
    takes no further part in the rounds.
    """
    n, w = len(text), packed_words(text)
    sa = np.argsort(w)
    new = np.r_[True, w[sa[1:]] != w[sa[:-1]]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # the empty suffix is the least
    head = np.flatnonzero(new)
    rank[sa] = np.repeat(head, np.diff(np.append(head, n)))
    h = 8
    single = new & np.append(new[1:], True)
    places = np.flatnonzero(~single)
    while h < depth and len(places):
        p = sa[places]
        key = (rank[p] << 32) | (rank[np.minimum(p + h, n)] + 1)  # group, then the group h bytes on
        order = np.argsort(key)
        p, key = p[order], key[order]
        sa[places] = p  # groups keep their places, so the sorted members go back in order
        new = np.r_[True, key[1:] != key[:-1]]
        head = np.flatnonzero(new)
        rank[p] = np.repeat(places[head], np.diff(np.append(head, len(p))))
        places = places[~(new & np.append(new[1:], True))]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, cap: int, lane: int = 64) -> np.ndarray:
    """Kasai's walk: bytes that sa[i] and sa[i-1] share, up to ``cap``.

    From a position to the next the shared length falls by one at most.  Where it was cut at ``cap`` the order of the two
    suffixes may be a tie's, so the next position starts from nothing unless its neighbour is the next one too.  Many
    stretches of the text are walked side by side, eight bytes a comparison.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    w = packed_words(np.concatenate([text, np.zeros(cap + 8, np.uint8)]))
    shared = np.zeros(n, np.int64)
    first = np.arange(0, n, lane)
    h, last = np.zeros(len(first), np.int64), np.full(len(first), -2, np.int64)
    for step in range(lane):
        i = first + step
        i = i[i < n]
        j = before[i]
        tie = (h[:len(i)] == cap) & (j != last[:len(i)] + 1)
        h = np.where(tie | (j < 0), 0, np.maximum(h[:len(i)] - 1, 0))
        last = j
        live = np.flatnonzero((j >= 0) & (h < cap))
        while len(live):
            x = w[i[live] + h[live]] ^ w[j[live] + h[live]]
            # leading equal bytes by the exponent; the bit below the highest is cleared, so that no rounding reaches a power
            equal = (64 - np.frexp((x & ~(x >> np.uint64(1))).astype(np.float64))[1]) >> 3
            h[live] += equal
            live = live[(equal == 8) & (h[live] < cap)]
        h = np.minimum(h, cap)
        shared[i] = h
    return shared[sa]


def local_repeats(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each of the ascending ``starts``: does its string occur at an earlier start of the shard?"""
    sa = suffix_array(text, length)
    shared = common_prefixes(text, sa, length)
    group = np.empty(len(text), np.int64)
    group[sa] = np.cumsum(shared < length)
    g = group[starts]
    first = np.full(int(group.max()) + 1, len(text), np.int64)
    np.minimum.at(first, g, starts)
    return first[g] < starts


# -- the distributed job ----------------------------------------------------------------------------------------------
def candidate_keys(src: DataFrame, length: int) -> DataFrame:
    """A key once for every place whose hash is the key of some string, so that a repeat inside a text counts too."""
    def run(batches):
        for b in small(batches):
            for *_, owner, at in text_groups(b, length):
                new = np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array((at[new] | PLACE).view(np.int64))], names=["key"])

    return src.mapInArrow(run, "key long")


def emit_runs(doc, text_key, base, piece, pos, text, key, gone, length: int):
    """Rows of a shard: repeats as spans (key ``REPEAT``), first occurrences as strings of neighbouring starts with one key."""
    gap = np.r_[True, (np.diff(pos) != 1) | (np.diff(piece) != 0) | (gone[1:] != gone[:-1])]
    for repeats in (True, False):
        new = gap if repeats else gap | np.r_[True, key[1:] != key[:-1]]
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(pos)) - 1
        pick = gone[head] == repeats
        head, tail = head[pick], tail[pick]
        if not len(head):
            continue
        p = piece[head]
        start, stop = base[p] + pos[head], base[p] + pos[tail] + length
        whole = text.tobytes()
        body = [None] * len(head) if repeats else [whole[s:e + length] for s, e in zip(pos[head].tolist(), pos[tail].tolist())]
        ids = doc[p]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(head), REPEAT, np.int64) if repeats else key[head].view(np.int64)),
             pa.array(ids, mask=ids == NO_ID), pa.array(text_key[p]), pa.array(start), pa.array(stop), pa.array(body, pa.binary())],
            names=["key", "doc_id", "text_key", "start", "stop", "body"])


def shard_parts(src: DataFrame, seen: RepeatFilter, length: int, shard_bytes: int) -> DataFrame:
    """Suffix arrays of the shards of a partition's candidate text."""
    def run(batches):
        held, size = [], 0
        for b in small(batches):
            for doc, text_key, base, text, starts, owner, key in text_groups(b, length):
                key |= PLACE
                if not len(key):
                    continue
                head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])  # neighbouring starts share their key
                may = np.repeat(seen.test(key[head].view(np.int64)), np.diff(np.append(head, len(key))))
                starts, owner, key = starts[may], owner[may], key[may]
                if not len(starts):
                    continue
                cut = np.flatnonzero(np.r_[True, (np.diff(starts) != 1) | (np.diff(owner) != 0)])
                for s, e in zip(cut.tolist(), np.append(cut[1:], len(starts)).tolist()):
                    o, lo = owner[s], starts[s]
                    # copies: a view would keep the whole group's arrays
                    held.append((doc[o], text_key[o], base[o] + lo, text[lo:starts[e - 1] + length].copy(), key[s:e].copy()))
                    size += e - s + length
                    if size >= shard_bytes:
                        yield from shard(held)
                        held, size = [], 0
        if held:
            yield from shard(held)

    def shard(held):
        held = sorted(held, key=lambda x: x[:3])
        # a repeated row brings the same pieces again
        held = [x for i, x in enumerate(held) if not i or x[:3] != held[i - 1][:3]]
        doc, text_key, start = (np.array([x[k] for x in held], np.int64) for k in range(3))
        n = np.array([len(x[3]) for x in held], np.int64)
        text, key = np.concatenate([x[3] for x in held]), np.concatenate([x[4] for x in held])
        first = np.cumsum(n) - n
        pos = ranges(first, n - length + 1)
        piece = np.repeat(np.arange(len(held)), n - length + 1)
        yield from emit_runs(doc, text_key, start - first, piece, pos, text, key, local_repeats(text, pos, length), length)

    return src.mapInArrow(run, PARTS)


def merge_block(place, text, n, length: int):
    """Strings of a block of rows in the order of key and place; True where an equal string is earlier in the block."""
    first = np.cumsum(n) - n
    pos = ranges(first, n - length + 1)
    row = np.repeat(np.arange(len(n)), n - length + 1)
    start = place[row, 2] + pos - first[row]
    h = string_hash(text, length)[pos]
    order = np.argsort(h, kind="stable")  # earliest first among equals, which have one key
    sorted_h = h[order]
    earliest = np.empty(len(pos), np.int64)
    earliest[order] = order[np.searchsorted(sorted_h, sorted_h)]  # binary search: the first of the same fingerprint
    later = np.flatnonzero(earliest != np.arange(len(pos)))
    w = packed_words(text)
    a, c = pos[later], pos[earliest[later]]
    same = np.ones(len(later), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        same &= w[a + k] == w[c + k]
    if not same.all():  # equal fingerprints of different strings: settle those by their bytes
        whole, met = text.tobytes(), {}
        for i in order[np.isin(sorted_h, h[later[~same]])].tolist():
            earliest[i] = met.setdefault(whole[pos[i]:pos[i] + length], i)
        later = np.flatnonzero(earliest != np.arange(len(pos)))
    gone = np.zeros(len(pos), bool)
    of, by = row[later], row[earliest[later]]  # a repeated row is the same place again
    gone[later] = (place[of, :2] != place[by, :2]).any(axis=1) | (start[later] != start[earliest[later]])
    return pos, row, start, gone


def merge_shards(parts: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """Repeats across shards among keys that fill half a block at most: spans (doc_id, text_key, start, stop)."""
    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            key = np.asarray(b.column(0))
            total = np.cumsum(np.diff(column_bytes(b.column(4))[1]))
            cuts = np.flatnonzero(np.r_[key[:1] != last, key[1:] != key[:-1]])  # rows that open a key
            at = 0
            while at < len(key):
                # a block ends before the first new key that finds it half full
                full = np.searchsorted(total, (total[at - 1] if at else 0) + block_bytes // 2 - size) + 1 if size < block_bytes // 2 else at
                cut = np.searchsorted(cuts, max(full, at if held else at + 1))
                end = int(cuts[cut]) if cut < len(cuts) else len(key)
                if end > at:
                    held.append(b.slice(at, end - at))
                    size += int(total[end - 1] - (total[at - 1] if at else 0))
                if cut < len(cuts):
                    yield from block(held)
                    held, size = [], 0
                at = end
            last = key[-1] if len(key) else last
        if held:
            yield from block(held)

    def block(held):
        b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        text, offs = column_bytes(b.column(4))
        rows = np.stack([np.asarray(b.column(1).fill_null(NO_ID)), np.asarray(b.column(2)), np.asarray(b.column(3))], 1)
        _, row, start, gone = merge_block(rows, text, np.diff(offs), length)
        at = np.flatnonzero(gone)
        if not len(at):
            return
        new = np.r_[True, (np.diff(row[at]) != 0) | (np.diff(start[at]) != 1)]
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        place = rows[row[at[head]]]
        place[:, 2] = start[at[head]]
        yield span_batch(place, start[at[tail]] + length)

    dealt = parts.select("key", "doc_id", "text_key", "start", "body").repartition(shuffle_width(parts.sparkSession), "key") \
        .sortWithinPartitions("key", "doc_id", "text_key", "start")
    return dealt.mapInArrow(run, SPANS)


def span_batch(place: np.ndarray, stop: np.ndarray):
    ids = place[:, 0]
    return pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NO_ID), pa.array(place[:, 1]), pa.array(place[:, 2]), pa.array(stop)],
                                      names=["doc_id", "text_key", "start", "stop"])


def hot_windows(parts: DataFrame, length: int) -> DataFrame:
    """A 128-bit fingerprint (a, c) and the place of every string."""
    def run(batches):
        for b in small(batches):
            data, offs = column_bytes(b.column(3))
            n = np.diff(offs)
            pos = ranges(offs[:-1], n - length + 1)
            row = pa.array(np.repeat(np.arange(len(n)), n - length + 1))
            start = pos + np.repeat(np.asarray(b.column(2)) - offs[:-1], n - length + 1)
            a = string_hash(data, length)[pos].view(np.int64)
            # the second hash reads the bytes backwards: of the string from pos it stands at the mirrored place
            c = string_hash(data[::-1], length)[len(data) - length - pos].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c), b.column(0).take(row), b.column(1).take(row), pa.array(start)],
                                             names=["a", "c", "doc_id", "text_key", "start"])

    return parts.select("doc_id", "text_key", "start", "body").mapInArrow(run, "a long, c long, doc_id long, text_key long, start long")


def merge_hot(parts: DataFrame, length: int) -> DataFrame:
    """Repeats across shards among the strings of hot keys, dealt by a 128-bit fingerprint of the whole string.

    A string comes once from a shard at most, so a fingerprint has as many rows as there are shards at most; only
    fingerprints and places move, and in the sorted rows of a task each string looks back to the first of its kind."""
    def run(batches):
        first = None  # fingerprint and place of the group that is open
        for b in batches:
            if not b.num_rows:
                continue
            ids = np.asarray(b.column(2).fill_null(NO_ID))
            rows = np.stack([np.asarray(b.column(0)), np.asarray(b.column(1)), ids, np.asarray(b.column(3)), np.asarray(b.column(4))], 1)
            if first is not None:
                rows = np.concatenate([first[None], rows])
            new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
            head = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
            gone = (rows[:, 2:] != head[:, 2:]).any(axis=1)
            first = head[-1]
            place = rows[gone, 2:]
            if len(place):  # neighbouring starts of a document as one span
                place = place[np.lexsort((place[:, 2], place[:, 1], place[:, 0]))]
                cut = np.flatnonzero(np.r_[True, (np.diff(place[:, 0]) != 0) | (np.diff(place[:, 1]) != 0) | (np.diff(place[:, 2]) > length)])
                yield span_batch(place[cut], place[np.append(cut[1:], len(place)) - 1, 2] + length)

    dealt = hot_windows(parts, length).repartition(shuffle_width(parts.sparkSession), "a", "c") \
        .sortWithinPartitions("a", "c", "doc_id", "text_key", "start")
    return dealt.mapInArrow(run, SPANS)


def merged_repeats(firsts: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """Repeats across shards.  Keys with more than half a block of strings are told by a sum over the written shards."""
    hot = firsts.groupBy("key").agg(F.sum(F.col("stop") - F.col("start")).alias("n")).where(F.col("n") > block_bytes // 2)
    hot = materialise(hot.select("key"), "suffix-hot-keys")
    if hot.isEmpty():
        return merge_shards(firsts, length, block_bytes)
    return merge_shards(join_checked(firsts, hot, "key", "left_anti"), length, block_bytes).unionByName(
        merge_hot(join_checked(firsts, hot, "key", "left_semi"), length))


def possible_repeats(part: DataFrame) -> DataFrame:
    """First occurrences whose key may stand in two rows of ``part``; the others are unique, or repeat in their shard only."""
    keys = part.where(F.col("key") != REPEAT).select("key")
    seen = RepeatFilter(filter_bits(keys.count())).build(keys)
    return part.where(F.col("key") != REPEAT).where(seen.udf()("key"))


def union_all(tables) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def union_spans(spans: list) -> list[list[int]]:
    """Overlapping or touching (start, stop) spans as maximal runs."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def suffix_dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", log2_bits: int = 28,
                 shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, slices: int | None = None) -> DataFrame:
    """One row per input row: doc_id, kept (the remaining bytes), n_bytes, n_removed, n_spans.

    ``slices`` (by default told by the text's bytes) is the number of tables, by key, that first occurrences are written to."""
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} at least")
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    seen = RepeatFilter(log2_bits, k=1).build(candidate_keys(src, length))
    n_bytes = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a key stays for half its reach on average
    tables = slice_tables(shard_parts(src, seen, length, shard_bytes), "key", slices or filter_slices(n_bytes * 2 // (length - GRAM + 1)),
                          "suffix-shards", "zstd")  # neighbouring strings overlap by most of their bytes, which this codec finds
    spans = union_all(t.where(F.col("key") == REPEAT).select("doc_id", "text_key", "start", "stop") for t in tables).unionByName(
        merged_repeats(union_all(map(possible_repeats, tables)), length, block_bytes))
    spans = materialise(spans.groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")), "suffix-spans")
    named = spans.select(F.xxhash64("_d", "_k").alias("h"))
    # each twice, as the filter keeps what occurs twice
    marked = RepeatFilter(filter_bits(spans.count())).build(named.unionAll(named)).udf()(F.xxhash64("doc_id", "text_key"))
    # spans grow with the documents, so this is a shuffled join at every size
    rows = src.where(marked).join(spans.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left") \
        .select("doc_id", "text", "spans").unionByName(src.where(~marked).select("doc_id", "text"), allowMissingColumns=True)

    def run(batches):
        for b in small(batches):
            out = []
            for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = t.encode()
                gone = union_spans([(s["start"], s["stop"]) for s in found]) if found else []
                edges = [0, *(x for span in gone for x in span), len(raw)]
                kept = b"".join(raw[a:e] for a, e in zip(edges[::2], edges[1::2]))
                out.append((kept, len(raw), len(raw) - len(kept), len(gone)))
            c = list(zip(*out))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c[0], pa.binary()), *(pa.array(x, pa.int64()) for x in c[1:])],
                                             names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
