"""Column-expression helpers (all JVM-side, codegen friendly, NULL-preserving)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def col_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """The column if the frame has it, else a typed NULL (a missing column acts as NULL)."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(dtype)


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` would not keep it)."""
    out = c
    if lo is not None and hi is not None:
        return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)
    if lo is not None:
        out = F.when(c < lo, F.lit(lo)).otherwise(c)
    if hi is not None:
        out = F.when(c > hi, F.lit(hi)).otherwise(c)
    return out


def safe_ratio(num: Column, den: Column, otherwise: Column | None = None) -> Column:
    """num/den when den > 0, else NULL (or ``otherwise``)."""
    expr = F.when(den > 0, num / den)
    return expr if otherwise is None else expr.otherwise(otherwise)


def nullif_zero_ratio(num: Column, den: Column) -> Column:
    """num / den with a zero denominator giving NULL (any sign allowed)."""
    return F.when(den != 0, num / den)


def log1p_clip(c: Column) -> Column:
    """log1p(max(x, 0)); NULL kept."""
    return F.log1p(clip(c, lo=0.0))


def right_closed_bucket(c: Column, edges: Sequence[float], labels: Sequence[str],
                        null_label: str | None = None, open_ends: bool = True) -> Column:
    """Label of the right-closed interval holding ``c``.

    ``open_ends``: edges are inner cut points, the first and last buckets are
    unbounded (``len(labels) == len(edges) + 1``).  Otherwise edges are the full
    list of bounds, the lowest bound excluded, and values outside get
    ``null_label`` (``len(labels) == len(edges) - 1``).
    """
    if open_ends:
        expr = None
        for edge, label in zip(edges, labels):
            cond = c <= edge
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
        expr = expr.when(c.isNotNull(), labels[-1])
    else:
        expr = None
        for lo, hi, label in zip(edges[:-1], edges[1:], labels):
            cond = (c > lo) & (c <= hi)
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if null_label is not None:
        expr = expr.otherwise(null_label)
    return expr


def risk_bucket(p: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed risk bands: p < b1 -> labels[0], ..., else labels[-1]."""
    expr = None
    for b, label in zip(bounds, labels):
        expr = F.when(p < b, label) if expr is None else expr.when(p < b, label)
    return expr.otherwise(labels[-1])


def clean_numeric(c: Column, dtype: T.DataType | None = None, null_tokens: Sequence[str] = ("", "nan", "None", "NULL")) -> Column:
    """Vendor text to DOUBLE: strip '%' and ',', trim, null tokens and bad text to NULL.

    A numeric column passes through as DOUBLE.  NaN never survives: ``try_cast``
    turns the text 'NaN' into NaN, which is mapped to NULL here.
    """
    if dtype is not None and not isinstance(dtype, T.StringType):
        v = c.cast("double")
    else:
        s = F.trim(F.regexp_replace(c, "[%,]", ""))
        v = F.when(s.isin(*null_tokens), F.lit(None).cast("double")).otherwise(s.try_cast("double"))
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def finite_or_null(c: Column) -> Column:
    """+-Infinity and NaN to NULL."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict | None = None) -> DataFrame:
    """Round every DOUBLE column (report outputs; engines differ in the last bits)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
