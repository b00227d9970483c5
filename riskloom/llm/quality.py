"""Quality classifier by co-training of two views.

The text view sees the text alone (character statistics and hashed byte trigrams); the metadata view sees source, lang
and length as the page's record states them.  Each view is a ridge logistic regression.  In every round a view labels the
unlabelled documents it is confident about, by its calibrated probability, for the other view to learn from: all unlabelled documents
of the table are scored, and the ``pseudo_rows`` most confident ones of all of them join the other view's rows.  At the
end both views are calibrated on labelled rows set aside, and their log-odds, less the prior counted twice, score
every document.

Fitting uses at most ``labelled_rows`` labelled documents (chosen by a hash of the id) and ``pseudo_rows`` a view and
round (parameters), so what reaches the driver is bounded whatever the corpus; all other work covers every row.  The
features of every document are written once, in half precision, for the rounds.

Null texts count as empty and null metadata is a value of its own.  Of several texts of one labelled doc_id the one with the
least hash is learned from; a null doc_id has no label and is not learned from.  A document labelled more than once has the majority
label (ties count as good); null labels are ignored.  With no labels, or labels of one class only, every document gets
that class's score (no labels: good) and nothing is learned.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_checked, materialise, small

TRIGRAMS = 256
STATS = 16
SOURCES, LANGS, LENGTHS = 32, 16, 16
META = SOURCES + LANGS + LENGTHS
PIECE = 1 << 20
THRESHOLD = 0.25  # a document is rejected below it; losing a clean one costs more than keeping a doubtful one


def text_features(text: str | None) -> np.ndarray:
    """Statistics and hashed trigram shares of a whole text."""
    t = text or ""
    out = np.zeros(STATS + TRIGRAMS, np.float32)
    raw = np.frombuffer(t.encode("utf-8", "replace"), np.uint8)
    n = len(raw)
    if not n:
        return out
    c = np.zeros(256, np.int64)
    grams = np.zeros(TRIGRAMS, np.int64)
    for s in range(0, n, PIECE):  # pieces bound the memory a very long text takes
        b = raw[s:s + PIECE + 2].astype(np.uint32)
        c += np.bincount(raw[s:s + PIECE], minlength=256)
        if len(b) > 2:
            h = ((b[:-2] * np.uint32(65599) + b[1:-1] * np.uint32(2654435761) + b[2:] * np.uint32(40503)) * np.uint32(2246822519)) >> np.uint32(24)
            grams += np.bincount(h, minlength=TRIGRAMS)
    words, lines = t.split(), t.split("\n")
    lens = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    letters = c[65:91].sum() + c[97:123].sum() + c[128:].sum()
    marks = n - letters - c[48:58].sum() - c[32] - c[9:14].sum()
    out[:STATS] = [
        np.log1p(n) / 10, c[65:91].sum() / n, c[48:58].sum() / n, c[32] / n, c[10] / n * 10, marks / n,
        c[128:].sum() / n, lens.mean() / 10, np.log1p(lens.max()) / 5, len(set(words)) / max(1, len(words)),
        len(set(lines)) / len(lines), (c[33] + c[63]) / n * 10, (c[35:39].sum() + c[42]) / n * 10, c[124] / n * 10,
        np.log1p(len(words)) / 10, c[46] / max(1, len(words))]
    out[STATS:] = np.sqrt(grams / max(1, n - 2))
    return out


def bucket(value, size: int) -> int:
    return 0 if value is None else 1 + zlib.crc32(str(value).encode("utf-8", "replace")) % (size - 1)


def meta_features(source, lang, n_chars) -> np.ndarray:
    out = np.zeros(META, np.float32)
    out[bucket(source, SOURCES)] = 1
    out[SOURCES + bucket(lang, LANGS)] = 1
    known = n_chars is not None and n_chars == n_chars and n_chars >= 0
    out[SOURCES + LANGS + (1 + min(LENGTHS - 2, int(np.log2(n_chars + 1))) if known else 0)] = 1
    return out


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept, which is not penalised."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pull[-1] = 1e-6
    for _ in range(rounds):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


class CoTrained:
    """Weights of both views and their calibrations; ``add`` gives a view rows that the other one has labelled."""

    def __init__(self, views, y):
        """``views``: feature matrices of the labelled rows, one per view."""
        self.mean = [v.mean(axis=0) for v in views]
        self.scale = [v.std(axis=0) + 1e-3 for v in views]
        self.views, self.y = [self.scaled(k, v) for k, v in enumerate(views)], y
        self.aside = np.arange(len(y)) % 5 == 0  # rows come in hash order; a fifth calibrates
        if len(set(y[self.aside])) < 2 or len(set(y[~self.aside])) < 2:
            self.aside = np.ones(len(y), bool)
        train = ~self.aside if not self.aside.all() else self.aside
        self.xs, self.ys = [v[train] for v in self.views], [y[train]] * 2
        self.prior = float(np.log(y.mean() / (1 - y.mean())))
        self.refit()

    def scaled(self, k, x):
        return (x - self.mean[k]) / self.scale[k]

    def refit(self):
        self.w = [fit(self.xs[k], self.ys[k]) for k in range(2)]
        self.cal = [fit(logit(self.views[k][self.aside], self.w[k])[:, None], self.y[self.aside], ridge=1e-3) for k in range(2)]

    def add(self, k, x, y):
        """Rows for view ``k``: its features and the labels that the other view gives them."""
        self.xs[k] = np.vstack([self.xs[k], self.scaled(k, x)])
        self.ys[k] = np.append(self.ys[k], y)

    def calibrated(self, k, x):
        """Calibrated log-odds of a view from scaled features."""
        return logit(logit(x, self.w[k])[:, None], self.cal[k])

    def probability(self, k, x):
        return logistic(self.calibrated(k, self.scaled(k, x)))

    def weights(self) -> "CoTrained":
        """What scoring needs, without the rows learned from."""
        out = object.__new__(CoTrained)
        out.mean, out.scale, out.w, out.cal, out.prior = self.mean, self.scale, self.w, self.cal, self.prior
        return out

    def score(self, text, meta):
        a, b = (self.calibrated(k, self.scaled(k, x)) for k, x in enumerate((text, meta)))
        return logistic(a), logistic(b), logistic(a + b - self.prior)


class Constant:
    def __init__(self, value: float):
        self.value = value

    def score(self, text, meta):
        v = np.full(len(text), self.value)
        return v, v, v


def features_of(text, source, lang, n_chars):
    rows = list(zip(text, source, lang, n_chars))
    # rounded to half precision, as the rounds of co-training see them
    return (np.array([text_features(r[0]) for r in rows], np.float16).reshape(-1, STATS + TRIGRAMS).astype(np.float32),
            np.array([meta_features(*r[1:]) for r in rows], np.float32).reshape(-1, META))


def majority(labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, y) of the labelled ids."""
    return labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(label_col) >= 0.5).cast("double").alias("y"))


def feature_table(docs: DataFrame, given: DataFrame) -> DataFrame:
    """Every document with an id, written once: doc_id, text_key, its features t and m (half precision), label y or null."""
    def run(batches):
        for b in small(batches):
            t, m = features_of(*(b.column(i).to_pylist() for i in (1, 2, 3, 4)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(5), pa.array([x.tobytes() for x in t.astype(np.float16)], pa.binary()),
                                              pa.array([x.tobytes() for x in m.astype(np.float16)], pa.binary())], names=["doc_id", "text_key", "t", "m"])

    key = F.xxhash64(F.coalesce("text", F.lit("")), F.col("source"), F.col("lang"), F.col("n_chars"))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text", "source", "lang", F.col("n_chars").cast("double").alias("n_chars"),
                                                   key.alias("text_key"))
    rows = rows.mapInArrow(run, "doc_id long, text_key long, t binary, m binary")
    given = materialise(given.select(F.col("doc_id").cast("long").alias("doc_id"), "y"), "quality-labels")
    return materialise(join_checked(rows, given, "doc_id", "left", row_bytes=64), "quality-features", "zstd")


def unpacked(col) -> np.ndarray:
    return np.array([np.frombuffer(x, np.float16) for x in col.to_pylist()], np.float32)


def most_confident(pool: DataFrame, model, k: int, n: int, confident: float, taken: set):
    """The ``n`` rows of the whole pool that view ``k`` is surest about (ties by a hash of the id), as an Arrow table of
    doc_id, text_key, p, t, m.  Each task hands on its own ``n`` at most."""
    shared = pool.sparkSession.sparkContext.broadcast((model.weights(), frozenset(taken)))

    def run(batches):
        best, (view, known) = None, shared.value
        for b in small(batches):
            p = view.probability(k, unpacked(b.column(2 + k)))
            sure = np.flatnonzero((p >= confident) | (p <= 1 - confident))
            sure = sure[[(i, t) not in known for i, t in zip(b.column(0).take(pa.array(sure)).to_pylist(), b.column(1).take(pa.array(sure)).to_pylist())]] if len(sure) else sure
            if not len(sure):
                continue
            rows = pa.Table.from_batches([b]).select(["doc_id", "text_key", "order", "t", "m"]).take(pa.array(sure))
            rows = rows.append_column("p", pa.array(p[sure])).append_column("sure", pa.array(np.abs(p[sure] - 0.5)))
            best = rows if best is None else pa.concat_tables([best, rows])
            best = best.sort_by([("sure", "descending"), ("order", "ascending"), ("doc_id", "ascending"), ("text_key", "ascending")]).slice(0, n).combine_chunks()
        if best is not None:
            yield from best.to_batches()

    order = F.xxhash64("doc_id", F.lit(7)).alias("order")
    found = pool.select("doc_id", "text_key", "t", "m", order).mapInArrow(
        run, "doc_id long, text_key long, order long, t binary, m binary, p double, sure double")
    return found.orderBy(F.col("sure").desc(), "order", "doc_id", "text_key").limit(n).toArrow()


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = 6000, pseudo_rows: int = 600, rounds: int = 3,
          confident: float = 0.95, label_col: str = "quality"):
    """Fit both views on a bounded labelled sample, and in each round on ``pseudo_rows`` of all unlabelled documents more."""
    rows = feature_table(docs, majority(labels, label_col))
    order = F.xxhash64("doc_id", F.lit(7))
    known = rows.where("y is not null").groupBy("doc_id").agg(F.min(F.struct("text_key", "y", "t", "m")).alias("r"))
    got = known.orderBy(order, "doc_id").limit(labelled_rows).select("doc_id", "r.*").toArrow()
    y = np.asarray(got["y"].to_pylist(), np.float64)
    if len(set(y)) < 2:
        return Constant(float(y[0]) if len(y) else 1.0)
    model = CoTrained([unpacked(got[c]) for c in ("t", "m")], y)
    pool, taken = rows.where("y is null"), [set(), set()]
    for _ in range(rounds):
        found = [most_confident(pool, model, k, pseudo_rows, confident, taken[k]) for k in range(2)]
        if not any(f.num_rows for f in found):
            break
        for k, f in enumerate(found):
            if not f.num_rows:
                continue
            taken[k].update(zip(f["doc_id"].to_pylist(), f["text_key"].to_pylist()))
            model.add(1 - k, unpacked(f["t" if k else "m"]), (np.asarray(f["p"].to_pylist(), np.float64) > 0.5).astype(float))
        model.refit()
    return model.weights()


def with_scores(docs: DataFrame, model, out_col: str = "quality_scores") -> DataFrame:
    """``docs`` and a struct column (text_score, meta_score, score); nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("text_score double, meta_score double, score double")
    def score(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        parts = []
        for i in range(0, len(text), 1000):
            cut = (c.iloc[i:i + 1000] for c in (text, source, lang, n_chars))
            parts.append(np.stack(shared.value.score(*features_of(*(c.astype(object).where(c.notna(), None) for c in cut))), axis=1))
        table = np.concatenate(parts) if parts else np.empty((0, 3))
        return pd.DataFrame(table, columns=["text_score", "meta_score", "score"])

    return docs.withColumn(out_col, score("text", "source", "lang", F.col("n_chars").cast("double")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, text_score, meta_score, score, kept for every document."""
    out = with_scores(docs.select("doc_id", "text", "source", "lang", "n_chars"), train(docs, labels, **options), "s")
    return out.select("doc_id", "s.text_score", "s.meta_score", "s.score", (F.col("s.score") >= threshold).alias("kept"))
