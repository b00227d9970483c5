"""Deduplication operators and the pipeline against plain versions."""

import hashlib
import os
import re
import subprocess
import sys

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import chunk_dedup, common, exact_dedup, line_dedup, simhash, suffix_dedup
from riskloom.llm import common
from riskloom.llm.common import RepeatFilter
from riskloom.llm.graph import components

NONE = -1 << 70
order = lambda i: NONE if i is None else i
digest = lambda b: hashlib.sha256(b).hexdigest()


def distinct(rows):
    """Documents in order: repeated rows are one."""
    return sorted(set(rows), key=lambda x: (order(x[0]), xxhash.xxh64_intdigest((x[1] or "").encode(), 42)))


def test_exact(docs, rows, rows_of, none):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), i == keep, digest((t or "").encode())))
    for bits in (24, 17):  # a nearly full filter changes nothing
        got = exact_dedup.exact_dedup(docs, log2_bits=bits)
        assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=str)
    got = exact_dedup.exact_dedup(docs, slices=3)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=str)
    assert exact_dedup.exact_dedup(none).count() == 0


def test_filter_size_holds_its_false_alarms():
    """Shares of unique hashes that pass, from the occupancy of a filter filled at its sizing rule, and at 30 GB of hashes."""
    r = np.random.default_rng(2)
    for n in (5_000, 33_000, 60_000, 131_072):
        f = RepeatFilter(common.filter_bits(n), 2)
        times = np.bincount(np.concatenate(f.positions(r.integers(-2 ** 62, 2 ** 62, n))), minlength=1 << f.log2_bits)
        words = np.packbits(times >= 2, bitorder="little")
        f.words = type("Held", (), {"value": words})
        own = r.integers(-2 ** 62, 2 ** 62, 20_000)  # of further hashes those pass whose positions others have set
        once = np.packbits(times >= 1, bitorder="little")
        f.words.value = once
        assert f.test(own).mean() < 0.05
    for hashes in (15_000_000, 468_000_000, 10 ** 11):
        assert hashes * common.FALSE_ALARM_BITS / common.filter_slices(hashes) <= 1 << common.MAX_FILTER_BITS


def test_hot_hash_does_not_fill_a_bucket(spark):
    h = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id")).alias("h")).repartition(4)
    sizes = []
    f = RepeatFilter(22, 2)
    take = type(h).repartition
    try:
        type(h).repartition = lambda self, n, *c: (sizes.extend(r[0] for r in self.groupBy("bucket").agg(F.sum(F.octet_length("packed"))).select(
            "sum(octet_length(packed))").collect()) if "bucket" in c else None) or take(self, n, *c)
        f.build(h)
    finally:
        type(h).repartition = take
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_repeat_filter_has_no_misses(spark):
    h = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 3000)
    df = spark.createDataFrame([(int(x),) for x in [*h, *h[:500]]] + [(None,)], "h long").repartition(7)
    f = RepeatFilter(20, 2).build(df)
    hit = f.test(h)
    assert hit[:500].all() and hit[500:].mean() < 0.05


def long_line(x):
    return len(re.findall(r"[^ \t\r]+", x)) >= 50


def line_chunks(text):
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, start = [], 0
    for i, x in enumerate(lines):
        last = i == len(lines) - 1
        chosen = (h[i] + (31 * h[i - 1] if i else 0)) % 2 == 0 or long_line(x) or (not last and long_line(lines[i + 1]))
        if last or (x.strip(" ") and chosen):
            out.append(lines[start:i + 1])
            start = i + 1
    return out


def lines_plain(rows, min_bytes=32):
    """Removed chunk positions of each document."""
    seen, gone = {}, {}
    for i, t in sorted(set(rows), key=lambda x: order(x[0])):
        run = []
        for k, c in enumerate([*line_chunks(t), None]):
            body, full = "\n".join(c or []), [x for x in c or [] if x.strip(" ")]
            if c is not None and (not full or seen.setdefault(body, (i, k)) != (i, k)):
                run.append((k, body, full))
                continue
            lines = [x for r in run for x in r[2]]
            if (len(lines) >= 2 or any(map(long_line, lines))) and sum(len(r[1].encode()) + 1 for r in run) >= min_bytes:
                gone.setdefault((i, t), set()).update(r[0] for r in run)
            run = []
    return gone


@pytest.mark.parametrize("min_bytes", [0, 32])
def test_lines(docs, rows, rows_of, none, min_bytes):
    gone, want = lines_plain(rows, min_bytes), []
    for i, t in rows:
        cs, g = line_chunks(t), gone.get((i, t), set())
        want.append((i, "\n".join("\n".join(c) for k, c in enumerate(cs) if k not in g) if g else t,
                     sum(map(len, cs)), sum(len(cs[k]) for k in g), len(g)))
    out = line_dedup.line_dedup(docs, min_bytes=min_bytes)
    assert out.columns == [*docs.columns, "line_dedup"]
    got = rows_of(out.select("doc_id", "text", "line_dedup.*"), "doc_id", "text", "n_lines", "n_removed_lines", "n_removed_chunks")
    assert got == sorted(want, key=str) and gone
    assert line_dedup.line_dedup(none).count() == 0


def test_lines_in_runs(spark):
    """Long single lines go wherever they stand, blank lines bridge a run, single short lines and first occurrences stay."""
    r = np.random.default_rng(8)
    line = lambda n=9: " ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(n))
    para = [line(60) for _ in range(3)]
    rows = [(i, "\n".join([line(), para[0], line(), line(), para[1], "", para[2], line(), "the same short line"])) for i in range(40)]
    got = {x.doc_id: x for x in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and got[0].line_dedup.n_removed_lines == 0
    for i, t in rows[1:]:
        assert not any(p in got[i].text for p in para)
        own = [x for x in t.split("\n") if x not in para and x]
        assert [x for x in got[i].text.split("\n") if x] == own
    plain = lines_plain(rows)
    assert all(got[i].line_dedup.n_removed_chunks == len(plain.get((i, t), ())) for i, t in rows)


def test_lines_plan_is_native(docs):
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan.replace("ArrowColumnar", ""))


def test_lines_of_long_texts_are_not_broadcast(spark, monkeypatch):
    # one row of removed runs, hundreds of them
    shared = [" ".join([f"w{i}"] * 60) for i in range(600)]
    df = spark.createDataFrame([(d, "\n".join(f"{x}\n{d} alone {i}" for i, x in enumerate(shared))) for d in (1, 2)], "doc_id long, text string")
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100)
    plan = line_dedup.line_dedup(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan and "strategy=merge" in plan


def test_lines_shift_resistance():
    block = [f"line {i} of the block" for i in range(60)]
    a, b = line_chunks("\n".join(block)), line_chunks("\n".join(["new", *block[:20], *block[25:]]))
    same = {"\n".join(x) for x in a} & {"\n".join(x) for x in b}
    hit = sum(any(x in block[20:25] for x in c) for c in a)
    assert len(same) >= len(a) - hit - 4  # beside what was deleted, two chunks an edit: boundaries see two lines


def passages_plain(rows):
    """Text and removed lines of each document: pairs of successive non-blank lines and lines of 50 words met before."""
    units = []
    for i, t in set(rows):
        lines = (t or "").split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" ")]
        for a, b in [*zip(full, full[1:]), *((k, k) for k, x in enumerate(lines) if len(re.findall(r"[^ \t\n\x0b\f\r]+", x)) >= 50)]:
            units.append(((order(i), a, t or ""), (i, t), b, tuple(lines[a:b + 1])))
    first, gone = {}, {}
    for place, doc, b, body in sorted(units, key=lambda u: u[0]):
        if first.setdefault(body, place) != place:
            gone.setdefault(doc, set()).update(range(place[1], b + 1))
    return {(i, t): ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t]) if (i, t) in gone else t,
                     len(gone.get((i, t), ()))) for i, t in rows}


def test_passages(docs, rows, rows_of, none):
    want = passages_plain(rows)
    out = line_dedup.passage_dedup(docs, min_bytes=0)
    assert out.columns == [*docs.columns, "line_dedup"]
    got = rows_of(out.select("doc_id", "text", "line_dedup.*"), "doc_id", "text", "n_removed_lines")
    assert got == sorted(((i, *want[i, t]) for i, t in rows), key=str) and any(n for _, n in want.values())
    assert line_dedup.passage_dedup(none).count() == 0
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString().replace("ArrowColumnar", ""))


def test_passages_have_a_least_size(spark):
    """Short pairs that many documents share stay; planted passages of 2 to 5 lines, and a long single line, go."""
    r = np.random.default_rng(4)
    line = lambda n=9: " ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(n))
    passages = [[line() for _ in range(k)] for k in (2, 3, 4, 5)] + [[line(60)]]
    short = ["Yes.\nNo.", "  }\n}", "a\n\nb"]
    rows, first = [], {}
    for i in range(120):
        k, s = i % 5, short[i % 3]
        rows.append((i, "\n".join([line(), s, line(), *passages[k], line(), s, line()])))
        first.setdefault(k, i)
    got = dict((x.doc_id, x) for x in line_dedup.passage_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    for i, t in rows:
        want = t if first[i % 5] == i else "\n".join(x for x in t.split("\n") if x not in passages[i % 5])
        assert got[i].text == want


def test_short_passages_between_other_lines_go(spark, monkeypatch):
    rows, planted = [], {}
    for n in range(1, 6):
        for k in range(4):
            words = 60 if n == 1 else 5
            block = [f"{n} {k} {x} " + " ".join(f"w{j}" for j in range(words)) for x in range(n)]
            for copy in range(2):
                i = 100 * n + 10 * k + copy
                around = [f"line {x} of document {i}" for x in range(6)]
                rows.append((i, "\n".join([*around[:3], *block, *around[3:]]), 0))
                planted[i] = "\n".join(around) if copy else rows[-1][1]
    # single short lines stay
    for i in (900, 901):
        rows.append((i, f"only here {i}\na short line\nand only here {i}", 0))
        planted[i] = rows[-1][1]
    monkeypatch.setattr(corpus_pipeline, "prepare", lambda s: None)
    got = corpus_pipeline.lines(spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), "").collect()
    assert {r.doc_id: r.text for r in got} == planted and all(r.n_chars == len(r.text) for r in got)


def test_pipeline_removes_runs_of_repeated_chunks(spark, monkeypatch):
    """Two lines that repeat one by one, never as a pair before, are a run of repeated chunks (op4's rule)."""
    even = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:7], 16) % 2 == 0  # noqa: E731  every such line ends a chunk
    line = iter([x for x in (f"a line of the text, number {i}" for i in range(200)) if even(x)])
    a, b, *other = [next(line) for _ in range(12)]
    texts = ["\n".join([other[0], a, other[1], other[2], b, other[3]]), "\n".join([other[4], a, b, other[5]])]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    monkeypatch.setattr(corpus_pipeline, "prepare", lambda s: None)
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {0: texts[0], 1: "\n".join(other[4:6])}
    assert got == {r.doc_id: r.text for r in line_dedup.line_dedup(docs).collect()}
    assert {r.doc_id: r.text for r in line_dedup.passage_dedup(docs).collect()} == dict(enumerate(texts))


def simhash_plain(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    sh = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values, near):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = list(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if near(a, b):
                root[find(a)] = find(b)
    return find


def test_simhash(docs, rows, none):
    fp = {t: simhash_plain(t) for _, t in rows}
    find = plain_components(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in rows:
        if i is not None:
            least[find(fp[t])] = min(i, least.get(find(fp[t]), i))
    want = sorted(((i, fp[t], least.get(find(fp[t]))) for i, t in rows), key=str)
    got = simhash.simhash_components(docs).collect()
    assert sorted(((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got), key=str) == want
    assert simhash.simhash_components(none).count() == 0


def test_simhash_links_of_large_groups(spark):
    r = np.random.default_rng(3)
    fps = set()
    for base in r.integers(0, 2 ** 63, 5):
        for width in (12, 64):
            for _ in range(60):
                x = int(base)
                for b in r.integers(0, width, r.integers(0, 5)):
                    x ^= 1 << int(b)
                fps.add(x)
    signed = [x - 2 ** 64 if x >= 2 ** 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    find = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    want, got = {}, {}
    for x in fps:
        want.setdefault(find(x), set()).add(x)
    for n, c in components(simhash.links(df)).collect():
        got.setdefault(c, set()).add(n % 2 ** 64)
    assert {frozenset(c) for c in want.values() if len(c) > 1} == {frozenset(c) for c in got.values()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 3), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 140)} == {100} and got[301] == 300
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def suffix_plain(rows, length):
    seen, out = set(), {}
    for i, t in distinct(rows):
        raw = (t or "").encode()
        mark = np.zeros(len(raw) + 1, np.int64)
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                mark[s] += 1
                mark[s + length] -= 1
            seen.add(w)
        gone = np.cumsum(mark)[:-1] > 0
        out[i, t or ""] = (len(raw), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()),
                           np.frombuffer(raw, np.uint8)[~gone].tobytes())
    return sorted(((i, *out[i, t or ""]) for i, t in rows), key=str)


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 4000, "block_bytes": 700, "slices": 3}])
def test_suffix_dedup(docs, rows, none, sizes):
    got = suffix_dedup.suffix_dedup(docs, **sizes).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == suffix_plain(rows, 100)
    if not sizes:
        assert suffix_dedup.suffix_dedup(none).count() == 0


def test_strings_of_a_hot_key_spread_over_tasks(spark, monkeypatch):
    r = np.random.default_rng(8)
    word = lambda n: "".join(r.choice(list("abcdefgh"), n))
    # a passage shorter than a string, with different edges in every document: one key, nearly all strings distinct
    passage = word(60)
    rows = [(i, word(80) + passage + word(80)) for i in range(300)]
    rows += [(1000 + i, rows[i][1][20:] + word(30)) for i in range(40)]
    dealt = []
    take = suffix_dedup.hot_windows
    monkeypatch.setattr(suffix_dedup, "hot_windows", lambda *a: dealt.append(take(*a)) or dealt[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = suffix_dedup.suffix_dedup(df, shard_bytes=4000, block_bytes=4000).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted(((*x[:4], bytes(x[4])) for x in got), key=str) == suffix_plain(rows, 100)
    # fingerprints and places only; one is as frequent as there are shards at most
    sent, = dealt
    assert "body" not in sent.columns and sent.groupBy("a", "c").count().agg(F.max("count")).first()[0] <= 20


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(6)
    for t in range(40):
        x = r.choice(np.frombuffer(b"ab\0", np.uint8), r.integers(1, 300))
        x = np.tile(x, 3) if t % 2 else x
        sa, pad = suffix_dedup.suffix_array(x, 128), x.tobytes() + b"\0" * 300
        assert sorted(sa) == list(range(len(x)))
        assert all(pad[a:a + 128] <= pad[b:b + 128] for a, b in zip(sa, sa[1:]))
        want = [0] + [next((h for h in range(100) if pad[a + h] != pad[b + h]), 100) for a, b in zip(sa, sa[1:])]
        assert suffix_dedup.common_prefixes(x, sa, 100).tolist() == want


def test_chunks(docs, rows, rows_of, none):
    seen, want = {}, {}
    for i, t in distinct(rows):
        raw = (t or "").encode()
        ends = chunk_dedup.chunk_ends(np.frombuffer(raw, np.uint8))
        assert (ends[-1] if ends else 0) == len(raw) and all(raw[:e].decode() is not None for e in ends)
        spans = [(s, e - s) for s, e in zip([0, *ends[:-1]], ends) if seen.setdefault(raw[s:e], (i, s)) != (i, s)]
        runs = chunk_dedup.merge_runs(spans, 100)
        kept = raw
        for a, b in reversed(runs):
            kept = kept[:a] + kept[b:]
        want[i, t or ""] = (kept.decode(), len(raw), len(raw) - len(kept), len(runs))
    got = rows_of(chunk_dedup.chunk_dedup(docs, log2_bits=20, slices=2), "doc_id", "text", "n_bytes", "n_removed", "n_spans")
    assert got == sorted(((i, *want[i, t or ""]) for i, t in rows), key=str)
    assert any(x[3] for x in got) and chunk_dedup.chunk_dedup(none).count() == 0


def test_chunks_find_a_shifted_passage():
    r = np.random.default_rng(2)
    words = lambda n: " ".join("".join(r.choice(list("abcdefgh"), r.integers(2, 9))) for _ in range(n))
    passage = words(70).encode()
    cut = lambda raw: {raw[a:b] for e in [chunk_dedup.chunk_ends(np.frombuffer(raw, np.uint8))] for a, b in zip([0, *e[:-1]], e)}
    shared = cut(words(40).encode() + b" " + passage + b" end") & cut(words(13).encode() + b" " + passage + b" " + words(9).encode())
    assert sum(map(len, shared)) > 0.5 * len(passage)


def test_pipeline(spark, docs, none, tmp_path, monkeypatch):
    bench = spark.createDataFrame([(1, "head line second")], "item_id long, text string")
    labels = spark.createDataFrame([(20, 1, 0)], "doc_id long, quality int, toxic int")
    made = {"labels": labels, "benchmark": bench, "documents": docs}
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: made[n])
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontam", "bpe"]
    now = docs
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.materialise(stage(spark, now, ""), "test-stage")
        assert now.columns == docs.columns
        counts.append(now.count())
    assert counts[0] == counts[1] == docs.count() > counts[2] > counts[3]
    ids = {r.doc_id for r in now.collect()}
    assert 16 not in ids and 5 not in ids and {4, 9, 10, 12}.issubset(ids)
    out = corpus_pipeline.run(spark, "")
    assert out.count() == counts[3]
    made["documents"] = none
    assert corpus_pipeline.run(spark, "").count() == 0


def test_nothing_else_imports_the_subpackage():
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as e; from riskloom.plans import catalog; catalog.load_all(); "
            "assert not [m for m in sys.modules if m.startswith('riskloom.llm')]; assert len(e.queries()) > len(catalog.QUERIES)") % here
    subprocess.run([sys.executable, "-c", code], check=True, timeout=100)
