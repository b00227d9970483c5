"""Vendor loan file to typed applications (B1-B16), one ``select`` + one filter.

The header plan (B1) is decided on the driver from ``df.columns`` only; every
row-level rule is a built-in column expression, so the whole cleaning runs in
one whole-stage-codegen span per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import constants as K
from ..functions.expr import clean_numeric, clip, finite_or_null

RAW_APPLICATION_COLUMNS = [
    "client_id", "application_date", "loan_amount", "loan_term", "interest_rate", "income",
    "employment_years", "home_ownership", "purpose", "dti_ratio", "credit_score", "num_open_accounts",
    "num_delinquencies", "revolving_balance", "revolving_utilization", "total_accounts",
    "pub_rec_bankruptcies", "grade", "total_credit_limit", "num_inquiries_6m", "is_default", "data_source",
]


def rename_plan(columns: Sequence[str], aliases: dict[str, str] = K.COLUMN_ALIASES) -> list[tuple[str, str]]:
    """B1: (source column, target name) pairs; header trimmed, alias match case-insensitive,
    the first column in file order wins a duplicate target."""
    values = set(aliases.values())
    seen: set[str] = set()
    plan = []
    for col in columns:
        name = col.strip()
        target = aliases.get(name.lower()) or (name if name in values else name)
        if target in seen:
            continue
        seen.add(target)
        plan.append((col, target))
    return plan


def rename_aliases(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in rename_plan(df.columns)])


def drop_footer(df: DataFrame, id_col: str = "id") -> DataFrame:
    """B2: drop footer rows whose id mentions Total or Loans (any case); a NULL id is kept."""
    if id_col not in df.columns:
        return df
    return df.where(~F.coalesce(F.col(id_col).cast("string").rlike("(?i)total|loans"), F.lit(False)))


def _plain_num(df: DataFrame, name: str) -> Column:
    """Numeric without the %/, stripping (the inquiries rule)."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        v = F.trim(c).try_cast("double")
    else:
        v = c.cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def bound(c: Column, name: str) -> Column:
    """Clip by the vendor clip table (NULL kept)."""
    lo, hi = K.CLIP_BOUNDS[name]
    return clip(c, lo, hi)


def parse_term(c: Column, dtype: T.DataType | None = None) -> Column:
    """B5: '36 months' -> 36; missing -> 36; clip 1..120; integer."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        v = c.cast("double")
    else:
        v = F.trim(F.regexp_replace(F.lower(c), "months", "")).try_cast("double")
        v = F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
    return F.floor(clip(F.coalesce(v, F.lit(36.0)), 1.0, 120.0)).cast("int")


def parse_employment(c: Column, dtype: T.DataType | None = None) -> Column:
    """n/a tokens missing; '<' 0.5; '10+' 10; else its digits; missing 0; clip 0..80."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        v = c.cast("double")
    else:
        t = F.lower(F.trim(c))
        digits = F.regexp_replace(t, "[^0-9.]", "")
        v = (F.when(t.isin(*K.EMPLOYMENT_NULL_TOKENS), F.lit(None).cast("double"))
             .when(t.startswith("<"), F.lit(0.5))
             .when(t.contains("10") & t.contains("+"), F.lit(10.0))
             .otherwise(F.when(digits != "", digits.try_cast("double"))))
    return bound(F.coalesce(v, F.lit(0.0)), "employment_years")


def parse_date(c: Column, dtype: T.DataType | None = None, default: str = K.DEFAULT_APPLICATION_DATE) -> Column:
    """B7: 'Mon-YYYY', else ISO date, else the default date (row rule)."""
    if dtype is not None and isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        d = c.cast("date")
    else:
        s = F.trim(c)
        d = F.coalesce(F.try_to_timestamp(s, F.lit("MMM-yyyy")), F.try_to_timestamp(s, F.lit("yyyy-MM-dd"))).cast("date")
    return F.coalesce(d, F.to_date(F.lit(default)))


def default_flag(df: DataFrame, explicit_present: bool | None = None) -> Column:
    """Explicit flag when the column has any value, else loan_status in the default set, else false.

    ``explicit_present`` is the result of one ``count(is_default)`` probe over
    the whole table; it is taken here when not given.
    """
    if "is_default" in df.columns:
        if explicit_present is None:
            explicit_present = df.agg(F.count("is_default").alias("n")).first()["n"] > 0
        if explicit_present:
            c = F.col("is_default")
            if isinstance(df.schema["is_default"].dataType, T.StringType):
                return F.coalesce(F.lower(c).isin(*K.TRUE_TOKENS), F.lit(False))
            return F.coalesce(c.cast("boolean"), F.lit(False))
    if "loan_status" in df.columns:
        return F.coalesce(F.col("loan_status").cast("string").isin(*K.DEFAULT_STATUSES), F.lit(False))
    return F.lit(False)


def normalise_home(c: Column | None) -> Column:
    """Upper + trim, null tokens to OTHER, at most 20 characters."""
    if c is None:
        return F.lit("OTHER")
    v = F.upper(F.trim(c.cast("string")))
    return F.substring(F.when(v.isNull() | v.isin(*K.HOME_OWNERSHIP_OTHER_TOKENS), F.lit("OTHER")).otherwise(v), 1, 20)


def normalise_purpose(c: Column | None) -> Column:
    """Lower + trim, null tokens to other, at most 50 characters."""
    if c is None:
        return F.lit("other")
    v = F.lower(F.trim(c.cast("string")))
    return F.substring(F.when(v.isNull() | v.isin(*K.PURPOSE_OTHER_TOKENS), F.lit("other")).otherwise(v), 1, 50)


def grade_ordinal(c: Column | None) -> Column:
    """A..G to 1..7, anything else 3."""
    if c is None:
        return F.lit(3)
    g = F.upper(c.cast("string"))
    pos = F.when(F.length(g) == 1, F.instr(F.lit(K.GRADES), g))
    return F.when(pos > 0, pos).otherwise(F.lit(3)).cast("int")


def count_field(c: Column, lo: float, hi: float) -> Column:
    """Missing 0, clip, integer (truncation)."""
    return F.floor(clip(F.coalesce(c, F.lit(0.0)), lo, hi)).cast("int")


def _stage_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Vendor text to DOUBLE once per column, in two projections (strip, then cast), so the
    later clips and defaults reference plain columns instead of re-evaluating regexes."""
    present = [n for n in names if n in df.columns]
    text = [n for n in present if isinstance(df.schema[n].dataType, T.StringType)]
    s1 = df.select("*", *[F.trim(F.regexp_replace(F.col(n), "[%,]", "")).alias(f"_s_{n}") for n in text])
    cast = []
    for n in present:
        if n in text:
            s = F.col(f"_s_{n}")
            v = F.when(s.isin(*K.NULL_NUMERIC_TOKENS), F.lit(None).cast("double")).otherwise(s.try_cast("double"))
        else:
            v = F.col(n).cast("double")
        cast.append(F.nanvl(v, F.lit(None).cast("double")).alias(f"_n_{n}"))
    return s1.select("*", *cast).drop(*[f"_s_{n}" for n in text])


NUMERIC_FIELDS = ["client_id", "external_id", "loan_amount", "interest_rate", "income", "dti_ratio", "credit_score",
                  "credit_score_high", "num_open_accounts", "num_delinquencies", "revolving_balance",
                  "revolving_utilization", "total_accounts", "pub_rec_bankruptcies", "total_credit_limit"]


def parsed_fields(raw: DataFrame, data_source: str = "vendor", explicit_default: bool | None = None,
                  usable_only: bool = False) -> DataFrame:
    """B1-B14 on every row (no row dropped yet); keeps ``external_id`` as the row key.

    ``usable_only`` applies B15 right after loan, income and date are parsed, so
    the filter runs on those three columns only and the remaining parsing is
    done for kept rows alone.
    """
    df = rename_aliases(drop_footer(raw))
    has = set(df.columns)
    typ = lambda n: df.schema[n].dataType if n in has else None
    default_col = default_flag(df, explicit_default)
    st = _stage_numeric(df, NUMERIC_FIELDS)
    num = lambda n: F.col(f"_n_{n}") if n in has else F.lit(None).cast("double")
    if "credit_score" in has and "credit_score_high" in has:
        credit = (num("credit_score") + num("credit_score_high")) / 2.0
    else:
        credit = num("credit_score")
    if "client_id" in has:
        cid, fallback = num("client_id"), num("external_id")
    else:
        cid, fallback = num("external_id"), F.lit(None).cast("double")
    # B10 (deviation: deterministic): vendor id, then a row hash for rows with neither
    row_hash = -F.abs(F.xxhash64(*[F.col(c) for c in df.columns]))
    client = F.coalesce(F.floor(finite_or_null(cid)), F.floor(finite_or_null(fallback)), row_hash).cast("bigint")
    # stage 2: bounded base values as columns
    st = st.select("*", bound(num("loan_amount"), "loan_amount").alias("_loan"),
                   bound(num("income"), "income").alias("_income"),
                   (parse_date(F.col("application_date"), typ("application_date")) if "application_date" in has
                    else F.to_date(F.lit(K.DEFAULT_APPLICATION_DATE))).alias("_date"))
    if usable_only:
        # after nanvl and the clip bounds the values are finite, so "present and > 0" is a
        # plain comparison; Catalyst pushes this filter below the projections with the
        # parsing inlined, so it references each parsed value once.
        st = st.where((F.col("_loan") > 0) & (F.col("_income") > 0) & F.col("_date").isNotNull())
    if "total_credit_limit" in has:
        limit_ = bound(num("total_credit_limit"), "total_credit_limit")
    else:
        limit_ = bound(F.col("_loan") * 2.0, "total_credit_limit")
    cols = {
        "external_id": F.col("external_id").cast("string") if "external_id" in has else F.lit(None).cast("string"),
        "client_id": client,
        "application_date": F.col("_date"),
        "loan_amount": F.col("_loan"),
        "loan_term": parse_term(F.col("loan_term"), typ("loan_term")) if "loan_term" in has else F.lit(36),
        "interest_rate": bound(num("interest_rate"), "interest_rate"),
        "income": F.col("_income"),
        "employment_years": parse_employment(F.col("employment_years"), typ("employment_years"))
        if "employment_years" in has else F.lit(0.0),
        "home_ownership": normalise_home(F.col("home_ownership") if "home_ownership" in has else None),
        "purpose": normalise_purpose(F.col("purpose") if "purpose" in has else None),
        "dti_ratio": bound(num("dti_ratio"), "dti_ratio"),
        "credit_score": bound(credit, "credit_score"),
        "num_open_accounts": count_field(bound(num("num_open_accounts"), "num_open_accounts"), 0.0, 500.0),
        "num_delinquencies": count_field(bound(num("num_delinquencies"), "num_delinquencies"), 0.0, 200.0),
        "revolving_balance": clip(num("revolving_balance"), 0.0, 1e9),
        "revolving_utilization": clip(num("revolving_utilization"), 0.0, 100.0),
        "total_accounts": count_field(num("total_accounts"), 0.0, 1000.0),
        "pub_rec_bankruptcies": count_field(num("pub_rec_bankruptcies"), 0.0, 100.0),
        "grade": grade_ordinal(F.col("grade") if "grade" in has else None),
        "total_credit_limit": limit_,
        "num_inquiries_6m": count_field(_plain_num(df, "num_inquiries_6m"), 0.0, 50.0),
        "is_default": default_col,
        "data_source": F.lit(data_source),
    }
    return st.select(*[c.alias(n) for n, c in cols.items()])


def usable() -> Column:
    """Loan, income and date present, both amounts above zero."""
    return (F.col("loan_amount").isNotNull() & F.col("income").isNotNull() & F.col("application_date").isNotNull()
            & (F.col("loan_amount") > 0) & (F.col("income") > 0))


def drop_unusable(df: DataFrame) -> DataFrame:
    """Infinities to NULL; loan, income and date present; loan > 0 and income > 0."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    df = df.select(*[finite_or_null(F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns])
    return df.where(usable())


def applications(raw: DataFrame, data_source: str = "vendor", explicit_default: bool | None = None) -> DataFrame:
    """Vendor rows to typed raw applications (plus the vendor ``external_id``)."""
    p = parsed_fields(raw, data_source, explicit_default, usable_only=True)
    # the B15 filter already ran inside; only the infinity-to-NULL projection is left
    doubles = [f.name for f in p.schema.fields if isinstance(f.dataType, T.DoubleType)]
    p = p.select(*[finite_or_null(F.col(c)).alias(c) if c in doubles else F.col(c) for c in p.columns])
    return p.select("external_id", *RAW_APPLICATION_COLUMNS)


# B16 -------------------------------------------------------------------------
def candidate_columns(df: DataFrame, target: str = "loan_status", extra_exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns whose name has no id/text pattern, not post-origination, not the target."""
    leak = set(K.LEAKAGE_COLUMNS) | set(extra_exclude) | {target, "is_default"}
    out = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.NumericType):
            continue
        if any(p in f.name.lower() for p in K.EXCLUDE_NAME_PATTERNS) or f.name in leak:
            continue
        out.append(f.name)
    return out
