"""Balance and plans of the order statistics."""

import re

from pyspark.sql import functions as F

from riskloom.operators import orderstat, profile


def test_ranges_are_fair_for_features_of_mixed_scale(spark):
    """26 features whose scales differ by up to 1e12: no range holds more than twice its share of the values."""
    n, nb = 4000, 16
    long = spark.range(n).select(F.explode(F.array(*[F.struct(F.lit(f"f{k:02d}").alias("feature"),
        ((F.col("id") * 7919 % n) * F.lit(10.0 ** (k / 2 - 6))).alias("value")) for k in range(26)])).alias("x")).select("x.*")
    got = orderstat.ranged(long, ["feature", "value"], nb).groupBy("_bucket").count()
    assert got.agg(F.max("count")).first()[0] <= 2 * 26 * n / nb and got.count() == nb


def test_row_index_splits_a_hot_date(spark):
    """A third of all rows on one date: right positions, and that date spans several ranges."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.to_date(F.lit("1999-01-01")))
                                    .otherwise(F.date_add(F.to_date(F.lit("1998-12-01")), (F.col("id") % 400).cast("int"))).alias("d"))
    got = orderstat.row_index(rows, ["d", "id"], n_buckets=12)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and not re.search(r"row_number", plan)
    got = got.toPandas().sort_values("row_idx")
    assert got.row_idx.tolist() == list(range(9000))
    assert got[["d", "id"]].apply(tuple, axis=1).is_monotonic_increasing
    hot = orderstat.ranged(rows, ["d", "id"], 12).where("d = '1999-01-01'")
    assert hot.select("_bucket").distinct().count() >= 3
    wide = orderstat.row_index(rows, ["id"], n_buckets=12).toPandas()
    assert (wide.row_idx == wide.id).all()


def test_chi_square_tail(spark):
    """Known values of the chi-squared distribution for odd, even and large degrees of freedom."""
    rows = [(3.841458820694124, 1, 0.05), (2.705543454095404, 1, 0.10), (7.814727903251179, 3, 0.05), (9.487729036781154, 4, 0.05),
            (124.34211340400407, 100, 0.05), (0.0, 3, 1.0), (2000.0, 5, 0.0)]
    df = spark.createDataFrame(rows, "x double, k int, p double")
    for r in df.select("p", profile.chi2_sf(F.col("x"), F.col("k")).alias("q")).collect():
        assert abs(r.p - r.q) < 1e-9


def test_chi_square_groups_and_null_labels(spark):
    counts = [("a", True, 30), ("a", False, 70), ("b", True, 45), ("b", False, 55), ("b", None, 500), (None, True, 9)]
    df = spark.createDataFrame([(g, y) for g, y, n in counts for _ in range(n)], "g string, is_default boolean")
    r = profile.chi_square(df, "g").first()
    assert r.dof == 1 and abs(r.chi2 - 4.181333333) < 1e-6 and 0.0407 < r.p_value < 0.0411
    more = df.union(spark.createDataFrame([("c", i % 3 == 0) for i in range(90)] + [("d", i % 2 == 0) for i in range(80)], df.schema))
    r = profile.chi_square(more, "g").first()
    assert r.dof == 3 and 0 < r.p_value < 0.05


def test_no_exchange_on_a_handful_of_keys(spark, small_dir):
    """With tables too large to broadcast by size, nothing is shuffled on feature, purpose or home_ownership alone."""
    from riskloom.plans import catalog

    catalog.load_all()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        for name in ("encode_join", "mutual_information", "class_distributions", "iqr_outliers"):
            plan = catalog.QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
            joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
            assert not [j for j in joins if re.fullmatch(r"(feature|purpose|home_ownership)#\d+", j.strip())], (name, joins)
            assert not re.search(r"hashpartitioning\((purpose|home_ownership)#\d+, ", plan), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_failed_replace_leaves_the_table(spark, tmp_path):
    from riskloom.sources import io

    out = str(tmp_path / "t")
    assert io.replace_table(spark.range(5), out) == 5
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    try:
        io.replace_table(bad, out)
    except Exception:
        pass
    assert io.read_table(spark, out).count() == 5
    # a table may be replaced by what is read from it
    assert io.replace_table(io.read_table(spark, out).where("id < 2"), out) == 2 and io.read_table(spark, out).count() == 2
