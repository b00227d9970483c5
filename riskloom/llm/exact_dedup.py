"""Exact deduplication by two-pass Bloom filtering.

Pass one counts filter positions of the text hashes and keeps the positions that two or more rows set
(``RepeatFilter``, sized by the number of rows, in slices by hash where one filter would be too large to broadcast, so that
under 5 % of unique rows pass at any size).  Pass two probes them: rows that miss are certainly unique and pass straight through without a
shuffle; only possible repeats are grouped by their SHA-256.  Only ids and digests move, never texts.

Null text counts as empty.  Rows that repeat both id and text are one document and are reported alike (each counts
in ``group_size``).  A null id loses to any other; if a group has only null ids, they stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, probed, sha256_hex


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None,
                log2_bits: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest id of the equal texts), group_size, kept, text_sha256."""
    base = docs.select(F.col(id_col).alias("doc_id"), sha256_hex(F.col(text_col)).alias("text_sha256"))
    # 60 bits of the digest are the filter's hash; the texts are read and hashed once
    h = F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long").alias("h")
    rows = probed(base.select("*", h), "h", docs.select(id_col).count(), "exact-digests", slices, log2_bits).drop("h")
    unique = rows.where("not possible").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    maybe = rows.where("possible").drop("possible")
    # real groups only, as a table of their own: the join below then sits right on its exchanges and a hot digest's
    # rows are split over tasks
    groups = materialise(maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep"), F.count("*").alias("n"))
                         .where("n > 1"), "exact-groups")
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    grouped = maybe.join(groups, "text_sha256", "left").select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")
    return unique.unionByName(grouped)
