from __future__ import annotations

import numpy as np
import pytest
from conftest import one, values
from pyspark.sql import functions as F

from creditloom.functions.quantiles import entity_quantiles, exact_quantiles, q_exact
from creditloom.operators import profiling as P
from creditloom.plans import reports


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share a group and a value, plus nulls."""
    return spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 4 == 0, 42.0).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("x"),
    )


@pytest.mark.parametrize("accuracy", [100, 1000, 100_000])
@pytest.mark.parametrize("kind", ["disc", "cont"])
def test_exact_quantiles_are_exact_at_any_sketch_accuracy(skewed, accuracy, kind):
    qs = [0.0, 0.1, 0.5, 0.99, 1.0]
    pdf = skewed.toPandas().dropna()
    got = {(r.g, r.q): r.value for r in exact_quantiles(skewed, ["x"], qs, ["g"], kind, accuracy).collect()}
    method = "inverted_cdf" if kind == "disc" else "linear"
    for g, part in pdf.groupby("g"):
        for q in qs:
            assert got[(g, q)] == pytest.approx(np.quantile(part["x"], q, method=method), abs=1e-6)


def test_exact_quantiles_of_small_groups(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1.0D), ('a', 2.0D), ('b', 5.0D), (NULL, 3.0D), ('c', NULL) AS t(g, x)")
    assert values(exact_quantiles(df, ["x"], [0.5], ["g"], "cont"), "g", "value") == [("a", 1.5), ("b", 5.0), (None, 3.0)]
    assert one(df.groupBy().agg(q_exact("x").alias("m"), q_exact("x", 0.5, "disc").alias("d"))) == (2.5, 2.0)


@pytest.mark.parametrize("kind", ["disc", "cont"])
def test_entity_quantiles_with_hot_entities(skewed, kind):
    got = values(entity_quantiles(skewed, "g", {"m": "x", "again": "x"}, 0.5, kind, hot_rows=3000), "g", "m", "again")
    plain = values(entity_quantiles(skewed, "g", {"m": "x", "again": "x"}, 0.5, kind), "g", "m", "again")
    assert got == plain and len(got) == 6


def test_null_profile_and_all_null_column(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (2, 3), (3, NULL) AS t(a, b)").withColumn("z", F.lit(None).cast("double"))
    rows = [tuple(r) for r in P.null_profile(df).collect()]
    assert rows == [("z", 3, 3, 100.0), ("b", 2, 3, 66.6667), ("a", 0, 3, 0.0)]
    assert P.null_profile(df, 1).count() == 1


def test_numeric_summary_methods_agree_on_small_data(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    a, e = one(P.numeric_summary(df, ["x"])), one(P.numeric_summary(df, ["x"], method="exact"))
    assert a.asDict() == e.asDict() and a.median == 50.0 and a.n == 101


def test_iqr_outliers(spark):
    df = spark.sql("SELECT * FROM VALUES (1), (2), (3), (4), (100), (NULL) AS t(x)")
    row = one(P.iqr_outliers(df, ["x"], method="exact"))
    assert (row.q1, row.q3, row.outliers, row.total, row.pct_outliers) == (2.0, 4.0, 1, 5, 20.0)


def test_histogram_keeps_every_row_and_empty_bins(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D), (10.0D), (9.99D), (NULL) AS t(x)")
    rows = P.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 0, 0, 0, 2] and rows[-1].upper == 10.0
    same = P.histogram(spark.sql("SELECT 3.0D AS x"), "x", 4).collect()
    assert sum(r.n for r in same) == 1
    assert P.histogram(spark.sql("SELECT CAST(NULL AS DOUBLE) AS x"), "x", 2).agg(F.sum("n")).first()[0] == 0


def test_rules_equal_one_scan_per_rule(spark):
    df = spark.sql("SELECT * FROM VALUES (1, -1.0D, 5), (1, -2.0D, 0), (2, 3.0D, 7), (3, NULL, NULL) AS t(k, a, b)")
    rules = {"neg": F.col("a") < 0, "big": F.col("b") > 4, "never": F.col("b") > 99}
    assert values(P.rule_violations(df, rules, "k")) == [("big", 2, 2, 50.0), ("neg", 2, 1, 50.0)]


def test_quality_and_inventory(spark):
    a = spark.sql("SELECT * FROM VALUES (1, NULL, 's'), (NULL, NULL, NULL) AS t(x, y, s)").withColumn("y", F.col("y").cast("double"))
    assert values(P.quality_resume({"a": a})) == [("a", 2, 3, 3)]
    assert values(P.table_inventory({"a": a, "b": a.limit(1)})) == [("a", 2), ("b", 1)]
    assert values(P.schema_inventory(spark, {"a": a})) == [("a", "s", "string"), ("a", "x", "int"), ("a", "y", "double")]


def test_validate_master_finds_duplicates(spark):
    base = spark.range(3).select(F.col("id").alias("k"), F.lit(0).alias("target"))
    master = base.union(base.limit(1)).withColumn("f", F.when(F.col("k") > 0, 1.0))
    got = {r.check_name: r.check_value for r in P.validate_master(master, base, "k", ["f"]).collect()}
    assert got["rows_master"] == 4 and got["rows_master_eq_base"] == 0 and got["duplicated_keys"] == 1
    assert got["distinct_keys"] == 3 and got["nulls_f"] == 2 and got["numeric_columns"] == 1


def test_quick_profile_and_kpis(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 10.0D, 'a'), (1, NULL, 'b') AS t(target, amt_credit, s)")
    for exact in (True, False):
        rows = {r.column: r for r in P.quick_profile(df, exact).collect()}
        assert rows["amt_credit"].nulls == 1 and rows["s"].distinct_values == 2 and rows["target"].role == "target"
    assert values(P.top_missing(P.quick_profile(df), 3), "column") == [("amt_credit",)]
    kpi = one(P.business_kpis(df))
    assert (kpi.rows, kpi.positive_rate_pct, kpi.mean_amount, kpi.amount_column) == (2, 50.0, 10.0, "amt_credit")


def test_category_rate_ignores_nulls_and_foreign_labels(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 0), (NULL, 1), ('b', 9) AS t(c, target)")
    assert values(P.category_rate(df, ["c"])) == [("c", "a", 2, 1, 50.0)]


@pytest.mark.parametrize("hot_rows", [0, 2, 1_000_000])
def test_entity_quantiles_keep_every_entity(spark, hot_rows):
    rows = [(1, None), (1, None), (1, None), (2, 1.0), (2, 2.0), (2, 9.0), (3, 4.0), (None, 5.0), (None, 7.0), (None, None), (None, 6.0)]
    df = spark.createDataFrame(rows, "k int, x double")
    got = {r.k: r.m for r in entity_quantiles(df, "k", {"m": "x"}, 0.5, "cont", hot_rows).collect()}
    assert got == {1: None, 2: 2.0, 3: 4.0, None: 6.0}


def test_histogram_counts_nan_apart(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,), (10.0,), (None,)], "x double")
    got = {r.bin: r.n for r in P.histogram(df, "x", 2).collect()}
    assert got == {1: 1, 2: 1, None: 1}


def test_label_summary_keeps_the_null_label(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (None, 5.0), (1, 2.0)], "target int, x double")
    got = {r.target: r.m for r in reports.label_summary(df, {}, quantiles={"m": ("x", 0.5)}, exact=True).collect()}
    assert got == {None: 3.0, 1: 2.0}
