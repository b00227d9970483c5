"""Registered queries of the training-data operators: thin reports over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op6_exact_dedup", """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


@register("op9_warc", """
with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages),
g as (select *, min(page_id) over (partition by html) as first from p)
select page_id, n as payload_bytes, sha256(html) as payload_digest,
       case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when n >= 100 and page_id <> first then first end as refers_to
from g""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import warc_round_trip

    return warc_round_trip(table(spark, sf_dir, "pages"))


@register("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import bpe_round_trip

    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op2_decontam")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination_report

    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .simhash import simhash_components

    out = simhash_components(table(spark, sf_dir, "documents"), size=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op8_langid")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .langid import identify, learn

    docs = table(spark, sf_dir, "documents")
    # a null doc_id has no remainder; it counts as training data
    held = lambda c: F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))
    model = learn(docs.where(~held(F.col("doc_id"))))
    out = identify(docs, model)
    return out.select("doc_id", held(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op4_line_dedup", """
with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
e as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i, len(ls) as n from l),
h as (select *, ('0x' || substr(md5(line), 1, 7))::bigint as h, trim(line, ' ') <> '' as has_text,
             regexp_matches(line, '^[ \\t\\r]*([^ \\t\\r]+[ \\t\\r]+){49}[^ \\t\\r]') as long from e),
r as (select *, i = n or (has_text and ((h + 31 * coalesce(lag(h) over w, 0)) % 2 = 0 or long or coalesce(lead(long) over w, false))) as is_end
      from h window w as (partition by doc_id order by i)),
c as (select *, coalesce(sum(is_end::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as pos from r),
k as (select doc_id, pos, string_agg(line, chr(10) order by i) as body, count(*) as lines,
             count(*) filter (has_text) as filled, bool_or(long) as long from c group by doc_id, pos),
m as (select *, filled = 0 or row_number() over (partition by body order by doc_id, pos) > 1 as again from k),
g as (select *, pos - row_number() over (partition by doc_id, again order by pos) as run from m),
q as (select *, again and (sum(filled) over v >= 2 or bool_or(long) over v) and sum(octet_length(encode(body)) + 1) over v >= 32 as gone
      from g window v as (partition by doc_id, again, run))
select doc_id, sum(lines) as n_lines, coalesce(sum(lines) filter (gone), 0) as n_removed_lines,
       count(*) filter (gone) as n_removed_chunks,
       sha256(coalesce(string_agg(body, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from q group by doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .common import sha256_hex
    from .line_dedup import line_dedup

    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[F.col(f"line_dedup.{c}").cast("long").alias(c) for c in ("n_lines", "n_removed_lines", "n_removed_chunks")],
                      sha256_hex(F.col("text")).alias("kept_sha256"))


@register("op10_chunk_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunk_dedup import chunk_dedup
    from .common import sha256_hex

    out = chunk_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256_hex("text").alias("kept_sha256"))


@register("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .suffix_dedup import suffix_dedup

    out = suffix_dedup(table(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), window=1024)


@register("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .common import sha256_hex
    from .periodic_runs import periodic_runs, with_planted_period

    out = periodic_runs(with_planted_period(table(spark, sf_dir, "documents")))
    # the greatest length/period, compared as fractions; ties: smallest start, then period
    before = ("(l, r) -> case when l.length * r.period <> r.length * l.period then if(l.length * r.period > r.length * l.period, -1, 1)"
              " when l.start <> r.start then if(l.start < r.start, -1, 1) when l.period < r.period then -1 when l.period > r.period then 1 else 0 end")
    best = F.get(F.expr(f"array_sort(runs, {before})"), F.lit(0))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = out.withColumn("best", best)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      sha256_hex(F.concat_ws("", listed)).alias("runs_sha256"), sha256_hex(F.col("collapsed")).alias("collapsed_sha256"))


@register("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"), drop_every=97)
