"""Packing documents into token windows by lexical retrieval.

Every text is encoded whole; full windows leave at once as sequences of their own, and what is left of a document (its
tail, shorter than a window) is indexed.  Tails are dealt into shards by their most telling terms, so that documents
on one subject meet, and each shard is a BM25 inverted index over token ids: the document that opens a window is the
query, and its best unused neighbours fill the window greedily.  The last one is cut where the window is full; its rest
opens the next window, so nothing is padded between windows.  Neighbours without a common term come last, in the
shard's order.

* Terms are token ids, so document frequencies are a table of the vocabulary's size, whatever the corpus: it is counted
  over all tails and broadcast.
* Shards are slices of about ``shard_tokens`` tokens, or ``shard_docs`` documents, of a range-partitioned order (telling terms, then row number), so
  copies in any number, or one subject that holds a third of all rows, spread over shards.
* The open window passes from one shard to the next of its task.  What a task's last window holds is cut at powers of
  two, which need no padding.

A null text is empty and has the end id alone.  Rows that repeat a doc_id, or a doc_id and its text, are packed each for
itself; a null doc_id is kept.  Extra columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols, groups
from .common import column_bytes, materialise, prepare, ranges, shuffle_width, small

# fixed value: the word pattern of byte-level tokenizer files
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
K1, B = 1.2, 0.75  # the usual BM25 parameters
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECE.split(", ")]


class Encoder:
    """Ids of whole texts.  Ranks of a byte-level file whose merges stand in the order of their ids go to the fast encoder;
    any other file, and a text that the fast one refuses, to the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.size = 1 + max([*vocab.values(), *[t["id"] for t in spec.get("added_tokens", [])]])
        self.library, self.fast = Tokenizer.from_file(path), None
        self.library.no_truncation()
        self.library.no_padding()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [vocab["".join(m)] for m in merges]
        if made == sorted(made) and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and spec.get("normalizer") is None:
            import tiktoken

            of_char = {c: b for b, c in enumerate(byte_symbols())}
            special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
            ranks = {bytes(of_char[c] for c in token): i for token, i in vocab.items() if token not in special}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its pattern engine refuses very long stretches of white space
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def term_counts(ids: np.ndarray, lens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of token arrays that lie one after another, by document, then term."""
    kind = np.int32 if len(lens) * size < 1 << 31 else np.int64  # narrow keys sort faster
    key, n = np.unique(np.repeat(np.arange(len(lens), dtype=kind), lens) * kind(size) + ids.astype(kind), return_counts=True)
    return (key // kind(size)).astype(np.int64), (key % kind(size)).astype(np.int64), n


class Bm25:
    """Weights from counts over all indexed documents."""

    def __init__(self, df: np.ndarray, docs: int, tokens: int):
        self.idf = np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.mean = max(1.0, tokens / max(1, docs))

    def weights(self, doc, term, n, lens):
        return self.idf[term] * n * (K1 + 1) / (n + K1 * (1 - B + B * lens[doc] / self.mean))


class Packer:
    """The windows of one task: documents of a shard in the order in which they fill windows, and their pieces."""

    def __init__(self, bm25: Bm25, size: int, window: int):
        self.bm25, self.size, self.window = bm25, size, window
        self.filled = 0  # tokens in the open window

    def order(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Documents of a shard in packing order; the window open at the start is filled first."""
        n = len(lens)
        doc, term, count = term_counts(ids, lens, self.size)
        weight = self.bm25.weights(doc, term, count, lens).astype(np.float32)
        by_term = np.argsort(term.astype(np.uint16) if self.size <= 1 << 16 else term, kind="stable")
        postings, post_weight = doc[by_term], weight[by_term]
        ends = np.cumsum(np.bincount(term, minlength=self.size))
        first = np.searchsorted(doc, np.arange(n + 1))
        used = np.zeros(n, bool)
        out, next_unused, room = [], 0, (self.window - self.filled) % self.window
        last = None  # the document that was cut, whose rest has opened the window
        while len(out) < n:
            if last is None:
                while used[next_unused]:
                    next_unused += 1
                last = next_unused
                used[last] = True
                out.append(last)
                room -= int(lens[last])
                if room <= 0:  # it opens a window, or ends one and opens the next
                    room %= self.window
                    if room:
                        continue
                    last = None
                    continue
            terms = term[first[last]:first[last + 1]]
            at = ends[terms - 1] * (terms > 0)
            hits = ranges(at, ends[terms] - at)
            score = np.bincount(postings[hits], weights=post_weight[hits], minlength=n)
            score[used] = -1.0
            while room > 0 and len(out) < n:
                k = min(n - len(out), max(64, room))
                best = np.argpartition(-score, k - 1)[:k] if k < n else np.arange(n)
                best = best[score[best] >= 0]
                best = best[np.lexsort((best, -score[best]))]
                take = best[:1 + int(np.searchsorted(np.cumsum(lens[best]), room))]
                out += take.tolist()
                used[take] = True
                score[take] = -1.0
                room -= int(lens[take].sum())
            last = out[-1] if room < 0 else None
            room %= self.window
        return np.array(out, np.int64)

    def cut(self, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, start in it, length, place in the stream of windows) of the pieces of documents laid end to end."""
        ends = self.filled + np.cumsum(lens)
        starts = ends - lens
        pieces = (ends - 1) // self.window - starts // self.window + 1
        doc = np.repeat(np.arange(len(lens)), pieces)
        k = ranges(np.zeros(len(lens), np.int64), pieces)
        begin = np.maximum(starts[doc], (starts[doc] // self.window + k) * self.window)
        end = np.minimum(ends[doc], (starts[doc] // self.window + k + 1) * self.window)
        return doc, begin - starts[doc], end - begin, begin


def halves(n: int) -> list[int]:
    """n as falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(docs: DataFrame, path: str, window: int = 1024, end_id: int = 0, shard_tokens: int = 1 << 19, shard_docs: int = 1 << 14, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id, offset.

    Each id of each document, and the ``end_id`` that closes it, lies in exactly one piece; the pieces of a sequence lie
    without gaps from offset 0 and fill ``window`` ids or a power of two."""
    spark = docs.sparkSession
    prepare(spark)
    size = load(path).size
    wide = "<u2" if size <= 1 << 16 else "<u4"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches):
        """Rows of three kinds: a document (row number, full windows, tail ids), and at the end a task's term counts."""
        task, rows, full = TaskContext.get().partitionId() << 33, 0, 0
        df, docs_n, tokens_n = np.zeros(size, np.int64), 0, 0
        for b in small(batches):
            for i, j in groups(b.column(1)):
                ids = [np.append(load(path)(t or ""), np.uint32(end_id)) for t in b.column(1)[i:j].to_pylist()]
                lens = np.array([len(x) for x in ids], np.int64)
                whole = lens // window
                tails = [x[w * window:] for x, w in zip(ids, whole)]
                sums = [[crc(x[k * window:(k + 1) * window]) for k in range(w)] for x, w in zip(ids, whole)]
                tail_lens = lens - whole * window
                _, term, _ = term_counts(np.concatenate(tails).astype(np.int64), tail_lens, size)
                df += np.bincount(term, minlength=size)
                docs_n, tokens_n = docs_n + int((tail_lens > 0).sum()), tokens_n + int(tail_lens.sum())
                before = full + np.cumsum(whole) - whole
                n = j - i
                yield batch(b.column(0)[i:j], task + rows + np.arange(n), lens, task + before, sums, [t.astype(wide).tobytes() for t in tails], n)
                rows, full = rows + n, full + int(whole.sum())
        term = np.flatnonzero(df)
        term, n = np.r_[-2, -1, term], np.r_[docs_n, tokens_n, df[term]]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(term), pa.int64()) for _ in range(4)] + [pa.nulls(len(term), pa.list_(pa.int64())),
                                         pa.nulls(len(term), pa.binary()), pa.array(term.astype(np.int32)), pa.array(n)], names=names)

    names = ["doc_id", "row", "doc_tokens", "first_full", "full", "tail", "term", "n"]

    def batch(doc_id, row, lens, first_full, sums, tails, n):
        return pa.RecordBatch.from_arrays([doc_id.cast(pa.int64()), pa.array(row), pa.array(lens), pa.array(first_full), pa.array(sums, pa.list_(pa.int64())),
                                           pa.array(tails, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names=names)

    coded = materialise(src.mapInArrow(encode, "doc_id long, row long, doc_tokens long, first_full long, full array<long>, tail binary, term int, n long"), "packing-ids")
    counts = {r["term"]: r["n"] for r in coded.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}  # the vocabulary at most
    df = np.zeros(size, np.int64)
    for t, n in counts.items():
        if t >= 0:
            df[t] = n
    bm25 = spark.sparkContext.broadcast(Bm25(df, counts.get(-2, 0), counts.get(-1, 0)))
    coded = coded.where("term is null")

    def tokens(col):
        data, offs = column_bytes(col)
        width = np.dtype(wide).itemsize
        return np.ascontiguousarray(data).view(wide).astype(np.int64), np.diff(offs) // width

    def telling(batches):
        """Adds a document's two heaviest terms."""
        for b in small(batches):
            ids, lens = tokens(b.column(3))
            doc, term, n = term_counts(ids, lens, size)
            weight = bm25.value.weights(doc, term, n, lens)
            by = np.lexsort((term, -weight, doc))
            at = np.searchsorted(doc, np.arange(len(lens)))  # every tail has a term
            top = term[by][at]
            two = np.minimum(at + 1, np.searchsorted(doc, np.arange(len(lens)), side="right") - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(top * size + term[by][two])], names=[*b.schema.names, "key"])

    tails = coded.where(F.length("tail") > 0).select("doc_id", "row", "doc_tokens", "tail")
    dealt = tails.mapInArrow(telling, "doc_id long, row long, doc_tokens long, tail binary, key long") \
        .repartitionByRange(shuffle_width(spark), "key", "row").sortWithinPartitions("key", "row")

    def fill(batches):
        packer = Packer(bm25.value, size, window)
        base, made = TaskContext.get().partitionId() << 33, 0
        open_, held = [], []  # pieces of the open window, and their ids, for the last cut
        for shard in shards(batches):
            ids, lens = tokens(shard.column(3))
            first = np.cumsum(lens) - lens
            order = packer.order(ids, lens)
            doc, start, length, place = packer.cut(lens[order])
            doc = order[doc]
            at = first[doc] + start
            ids = ids.astype("<u4")
            sums = [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(at.tolist(), length.tolist())]
            total = np.asarray(shard.column(2))
            rows = pa.RecordBatch.from_arrays([shard.column(0).take(pa.array(doc)), pa.array(total[doc] - lens[doc] + start), pa.array(length), pa.array(sums, pa.int64()),
                                               pa.array(total[doc]), pa.array(2 * (base + made + place // window) + 1), pa.array(place % window)], names=NAMES)
            done = (packer.filled + int(lens.sum())) // window
            packer.filled = (packer.filled + int(lens.sum())) % window
            closed = int(np.searchsorted(place // window, done))
            if done:
                yield from open_
                yield rows.slice(0, closed)
                open_, held = [], []
            open_.append(rows.slice(closed))
            held += [ids[a:a + n].copy() for a, n in zip(at[closed:].tolist(), length[closed:].tolist())]
            made += done
        if packer.filled:
            yield from last(pa.Table.from_batches(open_).to_pydict(), held)

    def last(rows, ids):
        """The pieces of the last window, cut into sequences of powers of two."""
        out = {c: [] for c in NAMES}
        seq, at, left = 0, 0, halves(sum(rows["length"]))
        for k in range(len(ids)):
            start = 0
            while start < rows["length"][k]:
                n = min(rows["length"][k] - start, left[seq] - at)
                for c, v in zip(NAMES, (rows["doc_id"][k], rows["start"][k] + start, n, crc(ids[k][start:start + n]), rows["doc_tokens"][k],
                                        rows["sequence_id"][k] + 2 * seq, at)):
                    out[c].append(v)
                start, at = start + n, at + n
                if at == left[seq]:
                    seq, at = seq + 1, 0
        yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.int64()) for c in NAMES], names=NAMES)

    def shards(batches):
        held, have = [], 0
        for b in small(batches):
            held.append(b)
            have += b.column(3).nbytes // np.dtype(wide).itemsize
            if have >= shard_tokens or len(held) * 512 >= shard_docs:
                yield from joined(held)
                held, have = [], 0
        if held:
            yield from joined(held)

    def joined(held):
        t = pa.Table.from_batches(held).combine_chunks()
        yield from t.to_batches()

    packed = dealt.mapInArrow(fill, PIECE)
    full = coded.where(F.size("full") > 0).select("doc_id", "doc_tokens", "first_full", F.posexplode("full").alias("k", "ids_crc32"))
    full = full.select("doc_id", (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                       (2 * (F.col("first_full") + F.col("k"))).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)
