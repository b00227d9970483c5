"""A training corpus from raw documents: five stages, each of which works on all that the stage before has kept.

quality      documents that the co-trained quality classifier rejects go
line_dedup   runs of repeated content-defined chunks of lines go (op4's rule), and the repeated passages whose edges its chunks
             reach across; a text may become empty, its row stays (``n_chars`` follows the text)
near_dedup   of each SimHash component the document with the smallest doc_id stays
decontam     documents in which a benchmark window occurs go
bpe          token ids of every remaining text, and the digest of what they decode to

Rows that repeat a doc_id stay or go together with it; a null doc_id is a key like any other.  Null texts count as
empty.  Extra columns travel along.  Empty tables pass through.  Intermediate results are Parquet tables in the folder
named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import bpe_round_trip
from riskloom.llm.common import join_checked, materialise, prepare, table
from riskloom.llm.decontam import contaminated_spans
from riskloom.llm.line_dedup import passage_dedup
from riskloom.llm.quality import THRESHOLD, train, with_scores
from riskloom.llm.simhash import simhash_components

#: The SQL of the whole pipeline: none, its stages learn, hash with XXH64 and merge byte pairs.
ORACLE_SQL = None


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``gone``; no text moves while ``gone`` is measured to be small."""
    gone = materialise(gone.select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return join_checked(docs, gone, docs["doc_id"].eqNullSafe(gone["gone_id"]), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    s = free_name(docs, "quality_scores")
    scored = with_scores(docs, train(docs, table(spark, sf_dir, "labels")), s)
    return scored.where(F.col(s)["score"] >= THRESHOLD).drop(s)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    report = free_name(docs, "line_report")
    return passage_dedup(docs, out_col=report, chunks=True).drop(report).withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash_components(docs, size=3)
    return without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = contaminated_spans(docs, table(spark, sf_dir, "benchmark"), window=10)
    return without(docs, found.where(F.size("spans") > 0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_dedup), ("decontam", decontaminate), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
