"""Retrieval packing: exact round trip of ids, gapless sequences, padding, and neighbours that belong together."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def whole(rows, pieces, window=1024):
    """Every id of every row lies in one piece; sequences are gapless and full or a power of two.  Returns padding."""
    t = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for i, text in rows:
        want[i].append(ids_of(t, text))
    got = defaultdict(list)
    for p in pieces:
        got[p["doc_id"]].append(p)
    assert got.keys() == want.keys()
    for i, docs in want.items():
        for total in {len(d) for d in docs}:
            same = [d for d in docs if len(d) == total]
            mine = [p for p in got[i] if p["doc_tokens"] == total]
            # a doc_id may be repeated: as many pieces cover each place as there are rows, each with a row's ids
            cover = np.zeros(total, int)
            for p in mine:
                cover[p["start"]:p["start"] + p["length"]] += 1
                assert p["ids_crc32"] in {zlib.crc32(np.array(d[p["start"]:p["start"] + p["length"]], "<u4").tobytes()) for d in same}
            assert (cover == len(same)).all()
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    pad = 0
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        pad += 0 if at & (at - 1) == 0 else window - at
    return pad


def test_encoder_equals_library(rows):
    t, e = Tokenizer.from_file(PATH), packing.load(PATH)
    assert e.fast is not None
    texts = [x or "" for _, x in rows] + ["".join(chr(c) for c in range(i, i + 512) if not 0xD800 <= c < 0xE000) for i in range(0, 0x11000, 512)]
    texts += [" " * 300_000, "\n" * 20_000 + "x", "a" * 20_000, "I'll we've <|endoftext|>x <|endoftext|>", "don'T  \t it's　\x85 'll"]
    for x in texts:
        assert e(x).tolist() == t.encode(x, add_special_tokens=False).ids


def test_query_keeps_every_id(spark, rows, tmp_path):
    spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, row string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op11_packing"](spark, str(tmp_path))
    assert whole(rows, out.collect()) == 0
    assert [c for c, t in out.dtypes if t == "bigint"] == packing.NAMES


@pytest.mark.parametrize("shard", [200, 5000])
def test_small_windows_and_shards(docs, rows, shard):
    assert whole(rows, packing.pack(docs, PATH, window=64, shard_tokens=shard).collect(), 64) == 0


def test_empty_table(none):
    assert packing.pack(none, PATH).count() == 0


def test_order_takes_the_best_unused_neighbour():
    """Against a plain BM25 over the shard: the document after a seed is its best neighbour, ties to the first."""
    r = random.Random(3)
    docs = [np.array([r.randrange(1, 12) for _ in range(r.randint(1, 9))]) for _ in range(40)]
    lens = np.array([len(d) for d in docs])
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=16)
    bm = packing.Bm25(df, len(docs), int(lens.sum()))
    packer = packing.Packer(bm, 16, 16)
    order = packer.order(np.concatenate(docs), lens).tolist()
    assert sorted(order) == list(range(40))

    def score(q, d):
        return sum(bm.idf[t] * (docs[d] == t).sum() * 2.2 / ((docs[d] == t).sum() + 1.2 * (0.25 + 0.75 * lens[d] / bm.mean)) for t in set(docs[q].tolist()))

    seed, fill, at = order[0], lens[order[0]], 1
    left = set(order[1:])
    while fill < 16:
        best = max(score(seed, d) for d in left)
        assert score(seed, order[at]) == pytest.approx(best, rel=1e-5)
        left.discard(order[at])
        fill += lens[order[at]]
        at += 1


def test_neighbours_share_a_subject(spark):
    r = random.Random(4)
    vocab = [[f"{chr(97 + s)}{''.join(r.choice('aeioubcd') for _ in range(5))}" for _ in range(30)] for s in range(12)]
    texts = [(i, i % 12, " ".join(r.choice(vocab[i % 12]) for _ in range(40))) for i in range(480)]
    r.shuffle(texts)
    docs = spark.createDataFrame(texts, "doc_id long, subject int, text string")
    out = packing.pack(docs, PATH, window=512, shard_tokens=1 << 16)
    met = out.join(docs.select("doc_id", "subject"), "doc_id").groupBy("sequence_id").agg(F.countDistinct("subject").alias("s"), F.countDistinct("doc_id").alias("d"))
    mixed = met.where("d > 1").agg(F.avg("s")).first()[0]
    assert mixed < 1.6
