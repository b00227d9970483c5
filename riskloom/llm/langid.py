"""Language identification by mixture inference over hashed byte trigrams.

Training counts trigrams per language over all training texts.  A document is taken as a mixture of languages:
expectation-maximisation estimates the proportions from its trigram likelihoods, and the set of languages is chosen by
penalised likelihood: a further language stays only if the log-likelihood gains more than
``penalty * log(number of trigrams)``.  All documents of a batch go through the rounds together.

A null text or one without a letter is ``und`` with score 0, as is everything when nothing was learned from.  Ties
between languages go to the first in sorted order.  Training rows with a null lang or text teach nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranges, small

BITS = 15
ALPHA = 0.5  # added to every count
ROUNDS = 10
GROUP_BYTES = 2 << 20
has_letter = regex.compile(r"\p{L}").search  # numerals such as ² or Ⅷ are no letters


def letter_bytes() -> np.ndarray:
    """Byte map: letters and bytes of other scripts stay, the rest of ASCII is a space."""
    t = np.arange(256, dtype=np.uint8)
    keep = np.zeros(256, bool)
    keep[97:123] = True
    keep[128:] = True
    return np.where(keep, t, 32).astype(np.uint8)


LETTERS = letter_bytes()


def trigrams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, bucket) of the trigrams of a byte array; those with two blanks in a row are left out."""
    b = LETTERS[raw].astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    blank = b == 32
    at = np.flatnonzero(~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:])))
    return at, ((code[at] * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def spaced(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace") + b" "


def bag(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) triples of a list of texts, sorted.  Long texts are counted piece by piece."""
    doc, bucket, count = [], [], []
    group, size = [], 0

    def close():
        nonlocal group, size
        if not group:
            return
        lens = np.array([len(r) for _, r in group], np.int64)
        at, h = trigrams(np.frombuffer(b"".join(r for _, r in group), np.uint8))
        # between texts stand two blanks, so no trigram crosses
        owner = np.searchsorted(np.cumsum(lens), at, side="right")
        key = np.sort((owner << BITS) | h)
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        doc.append(np.array([i for i, _ in group], np.int64)[key[cut] >> BITS])
        bucket.append(key[cut] & ((1 << BITS) - 1))
        count.append(np.diff(np.append(cut, len(key))))
        group, size = [], 0

    for i, t in enumerate(texts):
        raw = spaced(t)
        if len(raw) > GROUP_BYTES:
            close()
            total = np.zeros(1 << BITS, np.int64)
            for s in range(0, len(raw), GROUP_BYTES):
                _, h = trigrams(np.frombuffer(raw[s:s + GROUP_BYTES + 2], np.uint8))
                total += np.bincount(h, minlength=1 << BITS)
            seen = np.flatnonzero(total)
            doc.append(np.full(len(seen), i))
            bucket.append(seen)
            count.append(total[seen])
            continue
        group.append((i, raw))
        size += len(raw)
        if size > GROUP_BYTES:
            close()
    close()
    if not doc:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(doc), np.concatenate(bucket), np.concatenate(count)


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        """``counts``: trigram buckets x languages."""
        self.langs = langs
        self.p = ((counts + ALPHA) / (counts + ALPHA).sum(axis=0)).astype(np.float64)
        self.log_p = np.log(self.p)

    def em(self, p, w, starts, pi, rounds=ROUNDS):
        """Mixture proportions (documents x languages) after some rounds, and the log-likelihood they reach."""
        lens = np.diff(np.append(starts, len(w)))
        for _ in range(rounds):
            den = (p * np.repeat(pi, lens, axis=0)).sum(axis=1)
            pi = pi * np.add.reduceat(p * (w / den)[:, None], starts, axis=0)
            pi /= pi.sum(axis=1, keepdims=True)
        den = (p * np.repeat(pi, lens, axis=0)).sum(axis=1)
        return pi, np.add.reduceat(w * np.log(den), starts)

    def infer(self, bucket, count, starts, penalty: float):
        """Proportions of the chosen language set, one row per document; rows sum to one."""
        n_lang, w = len(self.langs), count.astype(np.float64)
        lens = np.diff(np.append(starts, len(w)))
        p = self.p[bucket]
        single = np.add.reduceat(w[:, None] * self.log_p[bucket], starts, axis=0)
        best = single.argmax(axis=1)
        chosen = np.zeros((len(starts), n_lang))
        chosen[np.arange(len(starts)), best] = 1.0
        if n_lang == 1:
            return chosen
        full, top = self.em(p, w, starts, np.full((len(starts), n_lang), 1.0 / n_lang))
        price = penalty * np.log(np.add.reduceat(w, starts) + 1)
        score = single[np.arange(len(starts)), best]
        # no set can gain more than all languages together do
        live = np.flatnonzero(top - score > price)
        rank = (-full).argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
        for k in range(2, n_lang + 1):
            if not len(live):
                break
            rows = ranges(starts[live], lens[live])
            mask = rank[live] < k
            pi = np.where(mask, np.maximum(full[live], 1e-6), 0)
            pi, ll = self.em(p[rows], w[rows], np.cumsum(lens[live]) - lens[live], pi / pi.sum(axis=1, keepdims=True))
            better = ll - (k - 1) * price[live] > score[live]
            score[live] = np.where(better, ll - (k - 1) * price[live], score[live])
            chosen[live[better]] = pi[better]
            live = live[better]
        return chosen


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Trigram counts per language over every training text.  The model grows with the languages, not the rows."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in small(batches):
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            doc, bucket, count = bag(texts)
            names = sorted(set(langs))
            of = np.array([names.index(x) for x in langs], np.int64)
            for k, name in enumerate(names):
                mine = of[doc] == k
                total[name] = total.get(name, 0) + np.bincount(bucket[mine], weights=count[mine], minlength=1 << BITS)
            if len(total) > 64:
                yield from emit(total)
                total = {}
        yield from emit(total)

    def emit(total):
        for name, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at].astype(np.int64))], names=["lang", "bucket", "n"])

    rows = train.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("t is not null and l is not null")
    got = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not got.num_rows:
        return None
    langs = sorted(set(got["lang"].to_pylist()))
    counts = np.zeros((1 << BITS, len(langs)))
    code = np.searchsorted(np.array(langs), np.array(got["lang"].to_pylist()))
    counts[got["bucket"].to_numpy(), code] = got["n"].to_numpy()
    return Model(langs, counts)


def identify(docs: DataFrame, model: Model | None, penalty: float = 3.0, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (its share of the text), langs and shares of the whole chosen set."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>"

    def run(batches):
        m = shared.value
        for b in small(batches):
            at = 0
            size = np.cumsum([len(t) if t else 0 for t in (x.as_py() for x in b.column(1))])
            while at < b.num_rows:  # groups of bounded length; a longer text stands alone
                done = size[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(size, done + GROUP_BYTES, side="right")))
                yield score(m, b.column(0).slice(at, end - at), b.column(1).slice(at, end - at).to_pylist())
                at = end

    def score(m, ids, texts):
        texts = [t if t and has_letter(t) else None for t in texts]
        known = [i for i, t in enumerate(texts) if t is not None] if m else []
        out = [("und", 0.0, [], [])] * len(texts)
        if known:
            doc, bucket, count = bag([texts[i] for i in known])
            order = np.argsort(doc, kind="stable")
            doc, bucket, count = doc[order], bucket[order], count[order]
            starts = np.searchsorted(doc, np.arange(len(known)))
            for i, share in zip(known, m.infer(bucket, count, starts, penalty)):
                use = np.flatnonzero(share > 0)
                use = use[(-share[use]).argsort(kind="stable")]
                out[i] = (m.langs[use[0]], float(min(1.0, share[use[0]])), [m.langs[j] for j in use], share[use].tolist())
        c = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(c[0]), pa.array(c[1], pa.float64()), pa.array(c[2], pa.list_(pa.string())),
             pa.array(c[3], pa.list_(pa.float64()))], names=["doc_id", "lang_pred", "score", "langs", "shares"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)
