"""Periodic stretches of words against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import periodic_runs as pr
from riskloom.llm import queries

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_lyndon(s):
    is_lyndon = lambda w: all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(s) + 1) if is_lyndon(s[i:j])) for i in range(len(s))]


def plain_runs(s, least, times):
    """Every maximal stretch with some smallest period, found period by period."""
    out, seen = [], set()
    for p in range(1, len(s) // max(2, times) + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p) and (i, j + p) not in seen:
                seen.add((i, j + p))
                out.append((i, j + p - i, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def report(doc_id, text):
    """The row of the registered query, from the rules."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w, 6, 4)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for b, k, q in runs for i in range(b + q, b + k)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{b},{k},{q}\n" for b, k, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=16))
def test_lyndon_array_under_both_orders(s):
    assert pr.lyndon_array(s) == plain_lyndon(s)
    assert pr.lyndon_array([-x for x in s]) == plain_lyndon([-x for x in s])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=4), st.integers(1, 6)), max_size=5), min_size=1, max_size=4),
       st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_of_lists(parts, rule):
    docs = [[x for unit, k in d for x in unit * k] for d in parts]
    got = [[tuple(x) for x in r.tolist()] for r in pr.runs_of(docs, *rule)]
    assert got == [plain_runs(d, *rule) for d in docs]


def test_collapsed_keeps_one_period():
    words = b"a b x y x y x y x y x c".split()
    runs = pr.runs_of([words])[0]
    assert runs.tolist() == [[2, 9, 2]] and pr.collapsed(words, runs) == b"a b x y c"


@pytest.fixture(scope="module")
def periodic_rows(rows):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abé漢") for _ in range(r.randint(1, 2)))
    more = []
    for i in range(100, 400):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts += [word() for _ in range(r.randint(1, 6))] * r.choice([1, 1, 2, 4, 7])
        more.append((i, r.choice([" ", "\n", " \t "]).join(parts)))
    # a long text that repeats from end to end, separators that are no ASCII white space, one word many times
    more += [(500, "la " * 2_000), (501, "a b " * 9), (502, "\x1cx " * 8), (503, " ".join(map(str, range(300))) + " end " * 9)]
    return rows + more


def test_query_equals_plain_version(spark, periodic_rows, rows_of, tmp_path):
    spark.createDataFrame([(i, t, "runs", 7) for i, t in periodic_rows], "doc_id long, text string, runs string, best int").write.parquet(
        str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    want = sorted((report(i, t) for i, t in periodic_rows), key=str)
    assert rows_of(out, *out.columns) == want
    assert sum(r[1] > 0 for r in want) > 50
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                                "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}


def test_empty_table(none):
    out = pr.periodic_runs(pr.with_planted_period(none))
    assert out.count() == 0 and out.columns == ["doc_id", "runs", "collapsed"]
