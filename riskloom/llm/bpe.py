"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A batch of texts is cut into words by the tokenizer's pattern, and only words not met before are encoded: their bytes
lie as symbols in one flat array, a word's lowest-rank pair is found by binary search of all neighbouring pairs in the
sorted pair keys, and one round merges that pair in every word at once.  Texts are then gathered from the encoded
words.  Special tokens that a text spells out become their ids, as the tokenizer file says.

Null texts count as empty and have no tokens.  The vocabulary is a parameter (a path every executor can read).
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, ranges, small

# fixed values: the word pattern of byte-level tokenizer files (their pre-tokenizer's use_regex)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Unicode white space, which is what \s means to the tokenizer file's pattern
WHITE = r"[\t\n\x0b\x0c\r\x20\x85\xa0  -     　]"
NOT_MERGEABLE = np.iinfo(np.int32).max
CACHE_WORDS = 150_000  # encoded words a worker keeps; beyond it the store starts anew
BATCH_BYTES = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Bpe:
    """Vocabulary, sorted pair keys and a store of encoded words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        of_char = {c: b for b, c in enumerate(byte_symbols())}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        pieces = [b""] * self.size
        for token, i in vocab.items():
            pieces[i] = bytes(of_char[c] for c in token)
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.piece_len = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_id = np.array([vocab[c] for c in byte_symbols()], np.int64)
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.pair_keys, self.pair_rank, self.pair_made = key[order], order.astype(np.int32), made
        pattern = PATTERN.replace(r"[^\s", "[^" + WHITE[1:-1]).replace(r"(?!\S)", f"(?!{'[^' + WHITE[1:]})").replace(r"\s", WHITE)
        self.words_of = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.flat = np.empty(0, np.int64)
        self.at, self.len = np.empty(0, np.int64), np.empty(0, np.int64)

    # -- encoding -------------------------------------------------------------------------------------------------
    def merge_rounds(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final ids and their number for words whose byte ids lie one after another in ``sym``."""
        n_words = len(lens)
        out_len = np.zeros(n_words, np.int64)
        word = np.repeat(np.arange(n_words), lens)
        done_sym, done_word = [], []
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            slot = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where((self.pair_keys[slot] == key) & (word[:-1] == word[1:]), self.pair_rank[slot], NOT_MERGEABLE)
            rank = np.append(rank, np.int32(NOT_MERGEABLE))
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            open_ = np.repeat(best != NOT_MERGEABLE, sizes)
            if not open_.all():  # finished words leave the array
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank = sym[open_], word[open_], rank[open_]
                sizes, best = sizes[best != NOT_MERGEABLE], best[best != NOT_MERGEABLE]
                if not len(sym):
                    break
            hit = rank == np.repeat(best, sizes)
            # of overlapping hits ("aaa") every second one counts, from the left
            at = np.flatnonzero(hit)
            run_start = np.r_[True, at[1:] != at[:-1] + 1]
            first = np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            sym = sym.copy()
            sym[at] = self.pair_made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.empty(0, np.int64), out_len
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=n_words).astype(np.int64)

    def learn(self, words: list[str]) -> None:
        """Encode words that the store does not have."""
        if not words:
            return
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, n = self.merge_rounds(self.byte_id[np.frombuffer(b"".join(raw), np.uint8)], lens)
        self.add(words, ids, n)

    def add(self, words, ids, n) -> None:
        base, text = len(self.flat), list(map(str, ids.tolist()))
        ends = np.cumsum(n)
        self.index.update(zip(words, range(len(self.at), len(self.at) + len(words))))
        self.texts += [",".join(text[e - k:e]) for e, k in zip(ends.tolist(), n.tolist())]
        self.at = np.append(self.at, base + ends - n)
        self.len = np.append(self.len, n)
        self.flat = np.append(self.flat, ids)

    def split(self, text: str) -> list[str]:
        """Words of a text; a special token is a word of its own."""
        if self.cut is None:
            return self.words_of(text)
        parts = self.cut(text)
        if len(parts) == 1:
            return self.words_of(text)
        out = []
        for i, p in enumerate(parts):
            out += [p] if i % 2 else self.words_of(p)
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """For each text its ids, and the same ids as decimal text joined by commas."""
        if len(self.texts) > CACHE_WORDS or len(self.flat) > 8 * CACHE_WORDS:
            self.clear()
        if self.special and not self.index:
            self.add(list(self.special), np.array(list(self.special.values()), np.int64), np.ones(len(self.special), np.int64))
        words = [self.split(t) for t in texts]
        new = set().union(*words) - self.index.keys()
        self.learn(sorted(new))
        ids, joined = [], []
        for ws in words:
            slot = list(map(self.index.__getitem__, ws))
            joined.append(",".join(map(self.texts.__getitem__, slot)))
            slot = np.array(slot, np.int64)
            ids.append(self.flat[ranges(self.at[slot], self.len[slot])])
        return ids, joined

    # -- decoding -------------------------------------------------------------------------------------------------
    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        raw = self.piece_bytes[ranges(self.piece_at[ids], self.piece_len[ids])]
        return raw.tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The tokenizer of this worker process, read once."""
    return Bpe(path)


def groups(col: pa.Array):
    """Index ranges of a batch whose texts have about BATCH_BYTES together; a longer text stands alone."""
    _, offs = column_bytes(col)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + BATCH_BYTES, side="right")) - 1)
        yield i, j
        i = j


def id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with an array<int> column of token ids (replaced if the name is taken)."""
    keep = [c for c in docs.columns if c != out_col]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("array<int>").alias(out_col)).schema

    def run(batches):
        for b in small(batches):
            text = b.column(keep.index(text_col))
            for i, j in groups(text):
                ids, _ = load(path).encode([t or "" for t in text[i:j].to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, id_lists(ids)], names=[*keep, out_col])

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def bpe_decode(ids: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``ids`` with the decoded text of an array column; null decodes to the empty text."""
    keep = [c for c in ids.columns if c != out_col]
    schema = ids.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("string").alias(out_col)).schema

    def run(batches):
        for b in small(batches):
            bpe, col = load(path), b.column(keep.index(ids_col))
            texts = [bpe.decode(np.asarray(x.values, np.int64)) if x.is_valid else "" for x in col]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*keep, out_col])

    return ids.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids, and return counts and digests of both (and the ids); no shuffle."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for b in small(batches):
            bpe = load(path)
            for i, j in groups(b.column(1)):
                ids, joined = bpe.encode([t or "" for t in b.column(1)[i:j].to_pylist()])
                cols = [b.column(0)[i:j], pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined]),
                        pa.array([hashlib.sha256(bpe.decode(x).encode("utf-8")).hexdigest() for x in ids])]
                if with_ids:
                    cols.append(id_lists(ids))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)
