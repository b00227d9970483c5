"""Exact quantiles by digit selection: counting instead of sorting.

A double is mapped to a 64-bit integer of the same order.  One pass counts the values by their first 16 bits; the cell
that holds a wanted rank is kept, and the next pass counts the next 16 bits of the values in the kept cells only.  A
cell whose least and greatest value are equal is decided at once, so values with few digits need two passes and any
values four at most.  No value is sorted or shuffled: a pass is one hash aggregation with map-side combine of at most
groups x 65,536 counters, and the driver receives one row per wanted rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

DIGIT = 16
SMALLEST, SMALLEST_NORMAL = 5e-324, 2.2250738585072014e-308


def _exponent(a: Column, guess: Column) -> Column:
    # log2 may be off by one next to a power of two; powers of two themselves are exact
    return guess + F.when(F.pow(F.lit(2.0), guess) > a, F.lit(-1.0)).when(F.pow(F.lit(2.0), guess + 1) <= a, F.lit(1.0)).otherwise(F.lit(0.0))


def _bits(x: Column, a: Column, e: Column) -> Column:
    fraction = ((a / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0 ** 52)).cast("long")
    return (F.when(F.isnan(x), F.lit((2047 << 52) + 1))
            .when(a == F.lit(float("inf")), F.lit(2047 << 52))
            .when(a < F.lit(SMALLEST_NORMAL), (a / F.lit(SMALLEST)).cast("long"))
            .otherwise((e + 1023).cast("long") * F.lit(1 << 52) + fraction))


def order_key(x: Column) -> Column:
    """A long that orders as the double ``x`` does (its IEEE magnitude bits with the sign; NaN is the greatest)."""
    a = F.abs(x)
    bits = _bits(x, a, _exponent(a, F.floor(F.log2(a)).cast("double")))
    return F.when(x < 0, -bits).otherwise(bits)


def _with_key(rows: DataFrame) -> DataFrame:
    """Adds ``_k``, the ``order_key`` of ``_v``, in steps: an expression that is used twice is computed once, and the
    generated code stays small enough to be compiled."""
    a, kept = F.abs("_v"), rows.columns
    rows = rows.withColumn("_e", F.floor(F.log2(a)).cast("double")).withColumn("_e", _exponent(a, F.col("_e")))
    rows = rows.withColumn("_b", _bits(F.col("_v"), a, F.col("_e")))
    return rows.select(*kept, F.when(F.col("_v") < 0, -F.col("_b")).otherwise(F.col("_b")).alias("_k"))


def _cells(rows: DataFrame, by: list[str], shift: int) -> DataFrame:
    """Counters of the digits at ``shift`` and the values they span, with running counts inside a kept cell.  The buffer
    holds numbers only, so that the values are hashed and not sorted."""
    c = rows.groupBy(*by, "_parent", F.shiftright("_k", shift).alias("_c")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    w = Window.partitionBy(*by, "_parent").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    return c.withColumn("_end", F.sum("_n").over(w))


def _hits(cells: DataFrame, targets: Column, by: list[str]) -> list:
    """One row per wanted rank: its cell, the rank inside it, and the cell's least and greatest value."""
    begin = F.col("_end") - F.col("_n")
    inside = F.filter(targets, lambda t: (t["rank"] >= begin) & (t["rank"] < F.col("_end")))
    return cells.select(*by, "_c", "_lo", "_hi", begin.alias("_begin"), F.explode(inside).alias("t")).select(
        *by, "_c", "_lo", "_hi", "t.i", (F.col("t.rank") - F.col("_begin")).alias("rank")).collect()


def _kept_cells(spark, kept: dict, group_type: T.StructType) -> DataFrame:
    """The kept cells with their wanted ranks, as literals: a row per wanted rank at most."""
    row = lambda g, c, t: F.struct(
        *[F.lit(x).cast(f.dataType).alias(f"_g{i}") for i, (x, f) in enumerate(zip(g, group_type))], F.lit(c).cast("long").alias("_parent"),
        F.array(*[F.struct(F.lit(i).cast("int").alias("i"), F.lit(r).cast("long").alias("rank")) for i, r in t]).alias("_t"))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*[row(g, c, t) for (g, c), t in kept.items()])))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy 'linear', SQL percentile_cont): (by..., p, q).

    NULL values are ignored; a group with no value has no row.  Groups are features, windows or models, a bounded
    number.  ``df`` is read once a pass, so it should be a table or a plain projection of one."""
    by, spark = list(by), df.sparkSession
    rows = df.where(F.col(value_col).isNotNull()).select(*by, F.col(value_col).cast("double").alias("_v"))
    rows = _with_key(rows)
    group_type = T.StructType([df.schema[c] for c in by])
    out_type = T.StructType([*group_type, T.StructField("p", T.DoubleType()), T.StructField("q", T.DoubleType())])

    first = _cells(rows.withColumn("_parent", F.lit(0).cast("long")), by, 64 - DIGIT)
    whole = Window.partitionBy(*by)
    first = first.withColumn("_total", F.sum("_n").over(whole))
    at = lambda p: (F.col("_total") - 1) * F.lit(float(p))
    wanted = F.array(*[F.struct(F.lit(2 * j + k).alias("i"), f(at(p)).cast("long").alias("rank"))
                       for j, p in enumerate(probs) for k, f in enumerate((F.floor, F.ceil))])
    totals = {tuple(r[c] for c in by): r["_total"] for r in first.select(*by, "_total").distinct().collect()}
    hits, value = _hits(first, wanted, by), {}
    for shift in range(64 - 2 * DIGIT, -1, -DIGIT):
        kept: dict[tuple, list] = {}
        for r in hits:
            g = tuple(r[c] for c in by)
            if r["_lo"] == r["_hi"] or r["_lo"] != r["_lo"]:
                value[g, r["i"]] = r["_lo"]
            else:
                kept.setdefault((g, r["_c"]), []).append((r["i"], r["rank"]))
        if not kept:
            break
        cells = F.broadcast(_kept_cells(spark, kept, group_type))
        same = F.lit(True)
        for i, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        inside = rows.join(cells.drop("_t"), same & (F.shiftright("_k", shift + DIGIT) == F.col("_parent")))
        counted = _cells(inside, by, shift).withColumnRenamed("_parent", "_of").join(cells, same & (F.col("_of") == F.col("_parent")))
        hits = _hits(counted, F.col("_t"), by)
    for r in hits:
        value[tuple(r[c] for c in by), r["i"]] = r["_lo"]
    out = []
    for g, total in totals.items():
        for j, p in enumerate(probs):
            h = (total - 1) * float(p)
            lo, hi = value[g, 2 * j], value[g, 2 * j + 1]
            out.append((*g, float(p), lo if lo == hi else lo + (h - int(h)) * (hi - lo)))
    return spark.createDataFrame(out, out_type).coalesce(1)
