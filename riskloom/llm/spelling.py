"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols.  If two words are one edit apart, their reduced words are at most one edit apart,
so each word sends its reduced word and the full one-edit neighbourhood of it (as 64-bit codes) to a join with the
reduced vocabulary; what meets is verified on the original strings.  A code clash only costs a comparison.

* Counting: one pass over the texts in the JVM, words pre-aggregated before the only shuffle of word counts.
* Neighbourhoods: codes are polynomial hashes put together from prefix and suffix sums, so a word of any length costs
  length x symbols numbers, never that many strings; a long word's codes leave in slices.
* The candidate join compares as it joins, so only words that are near leave it.
* Every word gets its near words from its own neighbourhood, so no pair is made twice and none is capped.

A null text or an empty table gives no words.  A null id counts as the empty id in the deletion rule of the query.
Repeated rows count as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_checked, materialise, mix64, prepare

# the letters of a word: A-Z (lower-cased before), a-z and the Latin-1 block from U+00C0 on
WORD = "[A-Za-zÀ-ÿ]+"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_SYMBOLS = 4
CARRIED = 40  # longer words are attached to their candidates afterwards
SLICE = 1 << 17  # codes of one output batch, about
BASE = np.uint64(0x9E3779B97F4A7C15)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None) -> DataFrame:
    """(word, n): occurrences of every run of letters, A-Z lower-cased.

    ``drop_every``: from an occurrence whose crc32 of ``id:word`` it divides, one letter (the crc32 modulo the length)
    is deleted before counting; a word that becomes empty is not counted.
    """
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    w = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(words).alias("word"))
    if drop_every:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("word")))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        w = w.withColumn("h", h).select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("word")).alias("word")).where("word <> ''")
    return w.groupBy("word").agg(F.count("*").alias("n"))


def symbols_of(letters: np.ndarray, count: int) -> np.ndarray:
    """The symbol (1..count) of each code point."""
    return mix64(letters.astype(np.uint64) * BASE) % np.uint64(count) + np.uint64(1)


def powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def reduced_code(sym: np.ndarray) -> np.ndarray:
    """Polynomial hash of one reduced word, modulo 2**64, and its length."""
    return mix64((sym * powers(len(sym))[:len(sym)]).sum(dtype=np.uint64)[None] + np.uint64(len(sym)))


def neighbourhoods(sym: np.ndarray, count: int):
    """(row, code) arrays: the reduced words of one length that are the rows of ``sym``, and all words one edit from each,
    each once, in slices.

    Deleting any letter of a stretch of equal ones, or adding one to it, gives one word: only its last place is used."""
    rows, n = sym.shape
    p = powers(n + 1)
    terms = sym * p[:n]
    before = np.zeros((rows, n + 1), np.uint64)  # sum of the first i terms
    np.cumsum(terms, axis=1, out=before[:, 1:])
    total = before[:, n:]
    after = (total - before) * BASE  # terms from i on, moved one place to the right
    left = np.zeros((rows, n), np.uint64)  # terms after i, moved one place to the left
    left[:, :n - 1] = np.cumsum((sym[:, 1:] * p[:n - 1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    at = np.nonzero(np.concatenate([sym[:, 1:] != sym[:, :-1], np.ones((rows, 1), bool)], 1))
    yield np.arange(rows), mix64(total[:, 0] + np.uint64(n))
    yield at[0], mix64(before[:, :n][at] + left[at] + np.uint64(n - 1))
    step = max(1, SLICE // (count * rows))
    letters = np.arange(1, count + 1, dtype=np.uint64)
    follows = np.concatenate([sym, np.zeros((rows, 1), np.uint64)], 1)  # the letter after each gap
    for i in range(0, n + 1, step):
        j = slice(i, min(i + step, n + 1))
        put = (before + after)[:, j, None] + letters * p[j][:, None]
        at = np.nonzero(follows[:, j, None] != letters)
        yield at[0], mix64(put[at] + np.uint64(n + 1))
        j = slice(i, min(i + step, n))
        other = (total - terms[:, j])[..., None] + letters * p[j][:, None]
        at = np.nonzero(sym[:, j, None] != letters)
        yield at[0], mix64(other[at] + np.uint64(n))


def letters_of(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), np.uint32)


def symbols_for(words: int) -> int:
    """As many symbols as make reduced words of eight letters about as many as the words."""
    return max(LEAST_SYMBOLS, round(max(1, words) ** 0.125))


def near_words(vocab: DataFrame, count: int) -> DataFrame:
    """(id, near, near_n): every ordered pair of words exactly one edit apart, by the first one's id.  ``vocab``: id,
    word, n.  A word of up to CARRIED letters travels with its codes and is compared in the join itself; a longer one
    travels by its id and is attached to what it met."""
    def own(batches):
        for b in batches:
            codes = [reduced_code(symbols_of(letters_of(w), count)) for w in b.column(0).to_pylist()]
            if codes:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(codes).view(np.int64))], names=["near", "near_n", "code"])

    def near(batches):
        for b in batches:
            ids, words = np.asarray(b.column(0)), b.column(1).to_pylist()
            lens = np.fromiter(map(len, words), np.int64, len(words))
            for n in np.unique(lens).tolist():
                same = np.flatnonzero(lens == n)
                step = max(1, SLICE // (n * count))
                for i in range(0, len(same), step):
                    some = same[i:i + step]
                    sym = np.stack([symbols_of(letters_of(words[k]), count) for k in some.tolist()])
                    for row, codes in neighbourhoods(sym, count):
                        take = pa.array(some[row])
                        word = b.column(1).take(take) if n <= CARRIED else pa.nulls(len(row), pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array(ids[some[row]]), word, pa.array(codes.view(np.int64))], names=["id", "word", "code"])

    one_edit = lambda word: (F.abs(F.length(word) - F.length("near")) <= 1) & (F.levenshtein(word, "near", 1) == 1)
    here = vocab.select("word", "n").mapInArrow(own, "near string, near_n long, code long")
    meet = lambda words: words.select("id", "word").mapInArrow(near, "id long, word string, code long").join(here, "code")
    long_ = vocab.where(F.length("word") > CARRIED)
    met = meet(vocab.where(F.length("word") <= CARRIED)).where(one_edit("word"))
    late = meet(long_).drop("word").join(long_.select("id", "word"), "id").where(one_edit("word"))
    return met.select("id", "near", "near_n").unionByName(late.select("id", "near", "near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last one, by pointer doubling.

    A form occurs at least twice as often as its word, so chains end, after at most log2 of the largest count steps;
    each round halves what is left of them."""
    now = materialise(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        up = now.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialise(join_checked(now, up, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                      F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not now.where("moved").limit(1).count():
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 5, min_count: int = 3,
                      ratio: int = 2, drop_every: int | None = None, symbols: int | None = None) -> DataFrame:
    """One row per word of ``min_letters`` letters and ``min_count`` occurrences or more: word, n, n_near (words one edit
    away), form (the most frequent of them, ties to the smallest, if it is ``ratio`` times as frequent; else null), form_n,
    and root (the last of the chain of forms; the word itself without one).  ``symbols`` changes the work, not the result."""
    prepare(docs.sparkSession)
    counted = count_words(docs, id_col, text_col, drop_every).where((F.length("word") >= min_letters) & (F.col("n") >= min_count))
    vocab = materialise(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    top = near_words(vocab, symbols or symbols_for(vocab.count())).groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.m") >= ratio * F.col("n")
    found = vocab.join(top, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n"))
    found = materialise(found, "spelling-forms")
    return found.join(roots(found), "word").select("word", "form", "root", "n", "n_near", "form_n")
