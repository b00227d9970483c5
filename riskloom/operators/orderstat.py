"""Order statistics without a global single-task window.

``Window.orderBy`` with no partition moves every row into one task.  Running sums and row positions keep the work
distributed:

1. pre-aggregate to one row per distinct ordering value (map-side combine, so a hot value is one row after the shuffle);
2. deal the rows into ranges of the order by Spark's range partitioner, and write them once with their range's number;
3. total each range (a row per range and group) and take exclusive running sums over that small table;
4. inside each range, running sums (or the position in the sorted range) plus the range's offset.

The result is exact wherever the ranges are cut; the cuts only balance the work.  AUC, KS, curves, thresholds and fold
indexes are built on it.  Quantiles need no order at all: see ``selection``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from . import selection


def _n_buckets(df: DataFrame, n_buckets: int | None) -> int:
    """Ranges per group: as many as the session shuffles into, so the width follows the cluster."""
    if n_buckets:
        return max(1, int(n_buckets))
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def group_key(by: Sequence[str]) -> Column:
    """One string per group (each part with a mark that tells NULL from text)."""
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in by])


def ranged(df: DataFrame, order_cols: Sequence[str], n_buckets: int | None = None, out: str = "_bucket") -> DataFrame:
    """``df`` sorted into ranges of ``order_cols`` and written once, with the number of the range.

    The range partitioner samples its cuts from all order columns together, so a first value that holds a third of all
    rows is cut on by the next column."""
    parts = df.repartitionByRange(_n_buckets(df, n_buckets), *order_cols).sortWithinPartitions(*order_cols)
    return materialise(parts.withColumn(out, F.spark_partition_id()), "ranges")


def prefix_sums(df: DataFrame, order_col: str, value_cols: Sequence[str], by: Sequence[str] = (),
                n_buckets: int | None = None, preaggregated: bool = False) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ascending ``order_col`` per ``by`` group.

    Returns one row per (by..., order value) with the summed values, ``cum_<v>``
    (inclusive running sum) and ``tot_<v>`` (group total).
    """
    by = list(by)
    vals = list(value_cols)
    if preaggregated:
        agg = df.select(*by, order_col, *vals)
    else:
        agg = df.groupBy(*by, order_col).agg(*[F.sum(v).alias(v) for v in vals])
    agg = ranged(agg, [*by, order_col], n_buckets)
    totals = agg.groupBy(*by, "_bucket").agg(*[F.sum(v).alias(f"_bt_{v}") for v in vals])
    wo = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*by) if by else Window.partitionBy()
    # small table: a range holds a part of one group or some whole groups, so about ranges + groups rows
    offsets = totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_bt_{v}").over(wo), F.lit(0)).alias(f"_off_{v}") for v in vals],
        *[F.sum(f"_bt_{v}").over(wt).alias(f"tot_{v}") for v in vals],
    )
    joined = agg.join(F.broadcast(offsets), [*by, "_bucket"], "inner")
    wi = Window.partitionBy(*by, "_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *by, order_col, *vals,
        *[(F.sum(v).over(wi) + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in vals],
        *[F.col(f"tot_{v}") for v in vals],
    )


def quantiles_of_sums(ps: DataFrame, probs: Sequence[float], by: Sequence[str] = (), value: str = "_v",
                      count: str = "_n") -> DataFrame:
    """Exact linear-interpolated quantiles from the running counts of ``prefix_sums``: (by..., p, q)."""
    by = list(by)
    h = lambda p: (F.col(f"tot_{count}") - 1) * float(p)
    targets = F.array(*[
        F.struct(F.lit(float(p)).alias("p"), h(p).alias("h"), F.floor(h(p)).alias("lo"), F.ceil(h(p)).alias("hi"))
        for p in probs
    ])
    start = F.col(f"cum_{count}") - F.col(count)
    end = F.col(f"cum_{count}") - 1
    hit = ps.where(F.col(count) > 0).select(*by, value, F.explode(F.filter(
        targets, lambda t: ((t["lo"] >= start) & (t["lo"] <= end)) | ((t["hi"] >= start) & (t["hi"] <= end))
    )).alias("t"), start.alias("_s"), end.alias("_e"))
    lo_hit = (F.col("t.lo") >= F.col("_s")) & (F.col("t.lo") <= F.col("_e"))
    hi_hit = (F.col("t.hi") >= F.col("_s")) & (F.col("t.hi") <= F.col("_e"))
    res = hit.groupBy(*by, F.col("t.p").alias("p")).agg(
        F.max(F.when(lo_hit, F.col(value))).alias("_vlo"),
        F.max(F.when(hi_hit, F.col(value))).alias("_vhi"),
        F.first(F.col("t.h")).alias("_h"), F.first(F.col("t.lo")).alias("_lo"),
    )
    return res.select(*by, "p", (F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))).alias("q"))


def value_counts(df: DataFrame, value_col: str, by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Running counts per distinct value: (by..., _v, _n, cum__n, tot__n); NULL values are ignored."""
    counts = df.where(F.col(value_col).isNotNull()).select(*by, F.col(value_col).cast("double").alias("_v"),
                                                            F.lit(1).cast("long").alias("_n"))
    return prefix_sums(counts, "_v", ["_n"], by, n_buckets)


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy 'linear', SQL percentile_cont): (by..., p, q), by digit selection.

    NULL values are ignored; a group with no value has no row.  The values are written once, for the passes."""
    values = df.select(*by, F.col(value_col).cast("double").alias(value_col))
    return selection.exact_quantiles(materialise(values, "values"), value_col, probs, by)


def edge_map(q: DataFrame, by: Sequence[str]) -> Column:
    """(group -> sorted distinct quantiles) as one map-valued scalar subquery, keyed by ``group_key``; it holds
    groups x quantiles numbers, so the rows that are binned with it need no join."""
    per = q.groupBy(*by).agg(F.array_sort(F.array_distinct(F.collect_list("q"))).alias("_e"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct(group_key(by), "_e"))).alias("m")).scalar()


def wide_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of many columns in one job: (feature, p, q).  The columns are written once and unpivoted pass by pass."""
    table = materialise(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "values")
    return selection.exact_quantiles(unpivot(table, cols), "value", probs, ["feature"])


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "feature",
            value: str = "value") -> DataFrame:
    """Wide to long (keep..., feature, value) with DOUBLE values."""
    casted = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(keep), list(cols), name, value)


def row_index(df: DataFrame, order_cols: Sequence[str], n_buckets: int | None = None, out: str = "row_idx") -> DataFrame:
    """0-based global row index in the order of ``order_cols`` (must be unique), without a window over rows.

    The rows are dealt into ranges and sorted there; the position in the sorted range is written with them, and the
    ranges' offsets (a row per range) are added.  Returns ``df`` with ``out`` added."""
    parts = df.repartitionByRange(_n_buckets(df, n_buckets), *order_cols).sortWithinPartitions(*order_cols)
    # the number is the task's, then the row's place in the task; one column of it each
    at = F.monotonically_increasing_id()
    parts = materialise(parts.withColumn("_at", at), "ranges")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    totals = parts.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))  # a row per range
    return parts.withColumn("_part", part).join(offsets, "_part").withColumn(out, place + F.col("_off")).drop("_part", "_off", "_at")
