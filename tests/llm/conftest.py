import random

import pytest
from pyspark.sql import functions as F

from riskloom.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, spans int, n int, gone string, size int"
CLASH = ("k", "f", 1, 2, "g", 3)  # extra columns named like the operators' own


def corpus() -> list[tuple]:
    """(doc_id, text): nulls, empty and very long texts, repeats, ties, shared passages, odd bytes."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdeé漢") for _ in range(r.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    block = "\n".join(" ".join(word() for _ in range(8)) for _ in range(12))
    rows = [(None, None), (0, None), (1, ""), (2, ""), (3, "   \n\t \n"), (4, "a"), (5, "a"), (6, "!!! 12 ..."),
            (7, "x" * 3000), (8, "ab" * 700), (9, "tab\there \x00 nul \x85 nbsp\xa0 end"), (10, "<|endoftext|> and I'll \r\n\r\n go  <|endoftext|>"),
            (None, "a null id with some words in it"), (12, passage), (12, passage), (13, "intro " + passage + " outro"),
            (14, passage.upper()), (15, block), (16, "head line\nsecond\n" + block + "\ntail"), (17, block + "\n" + block),
            (18, passage.replace(passage.split()[30], "changed", 1)), (19, None)]
    rows += [(20 + i, "\n".join(" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(r.randint(1, 9)))) for i in range(25)]
    rows += [(60 + i, rows[25 + i % 5][1]) for i in range(8)]
    rows.append((99, " ".join(word() for _ in range(30_000))))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    prepare(spark)
    full = [(i, t, (None, "xx", "yy")[k % 3], (None, "s1")[k % 2], None if t is None else len(t), *CLASH) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5, F.col("n_chars"))


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


def collected(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.fixture(scope="session")
def rows_of():
    return collected
