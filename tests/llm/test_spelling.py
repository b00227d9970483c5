"""Spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import queries
from riskloom.llm import spelling as sp

LETTERS = "abczÀ×÷ÿ"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=str)


def codes_of(text, count):
    return sp.symbols_of(np.array([ord(c) for c in text], np.uint32), count)


@settings(max_examples=200, deadline=None)
@given(st.text(LETTERS, min_size=1, max_size=7), st.sampled_from([2, 4, 8]), st.randoms())
def test_neighbourhood_is_full_and_tight(word, count, r):
    sym = codes_of(word, count)
    both = list(sp.neighbourhoods(np.stack([sym[::-1], sym]), count))
    every_code = np.concatenate([c[row == 1] for row, c in both]).tolist()
    got = set(every_code)
    assert len(got) == len(every_code)
    s, every = tuple(sym.tolist()), range(1, count + 1)
    words = {s} | {s[:i] + s[i + 1:] for i in range(len(s))}
    words |= {s[:i] + (c,) + s[i + 1:] for i in range(len(s)) for c in every}
    words |= {s[:i] + (c,) + s[i:] for i in range(len(s) + 1) for c in every}
    assert got == {int(sp.reduced_code(np.array(w, np.uint64))[0]) for w in words}


def test_long_word_leaves_in_slices():
    parts = [c for _, c in sp.neighbourhoods(np.ones((1, 100_000), np.uint64), 8)]
    assert len(parts) > 2 and max(map(len, parts)) <= sp.SLICE


@pytest.fixture(scope="module")
def texts(rows):
    r = random.Random(9)
    stems = ["".join(r.choice(LETTERS) for _ in range(r.randint(3, 9))) for _ in range(60)]
    # forms of forms, ties
    more = [(300 + i, w + " ") for i, w in enumerate(["letter " * 24, "lettes " * 12, "lettis " * 6, "lattis " * 3, "tie tiesé tiesa " * 4, "tieses " * 9])]
    for i in range(200, 300):
        words = []
        for _ in range(r.randint(0, 60)):
            w = r.choice(stems)
            k = r.randrange(len(w) + 1)
            words.append(r.choice([w, w, w.upper(), w[:k] + r.choice(LETTERS) + w[k:], w[:k] + w[k + 1:], w[:k] + r.choice(LETTERS) + w[k + 1:]]))
        more.append((i, r.choice([" ", "-", "1", "Ā"]).join(words)))
    more += [(400 + i, "y" * 4000 + " " + "y" * 4001) for i in range(4)]
    return rows + more


def test_query_equals_plain_version(spark, texts, rows_of, tmp_path):
    spark.createDataFrame([(i, t, "word", 7) for i, t in texts], "doc_id long, text string, word string, n int").write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op13_spelling"](spark, str(tmp_path))
    want = plain(texts)
    assert rows_of(out, *out.columns) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_few_symbols_give_the_same(docs, rows_of):
    a, b = (sp.spelling_variants(docs, min_letters=2, min_count=1, symbols=k) for k in (2, 8))
    assert rows_of(a, *a.columns) == rows_of(b, *b.columns)


def test_empty_table(none):
    assert sp.spelling_variants(none).count() == 0
