from __future__ import annotations

import math

import pytest
from conftest import one, values
from pyspark.sql import functions as F

from creditloom.functions import rowexpr as R
from creditloom.functions.naming import business_role, clean_name, value_columns


def test_ratio_guards(spark):
    df = spark.sql("SELECT * FROM VALUES (6, 3), (6, 0), (6, -3), (6, NULL), (NULL, 3) AS t(a, b)")
    got = [tuple(r) for r in df.select(R.safe_ratio("a", "b").alias("x"), R.safe_ratio("a", "b", "positive").alias("y")).collect()]
    assert got == [(2.0, 2.0), (None, None), (-2.0, None), (None, None), (None, None)]
    smooth = R.safe_ratio("a", "b", offset=1.0, den_default=1.0).alias("x")
    assert [r.x for r in df.select(smooth).collect()] == [1.5, 6.0, -3.0, 3.0, None]
    with pytest.raises(ValueError):
        R.safe_ratio("a", "b", "maybe")


def test_null_rules_of_bounds(spark):
    # SQL greatest and least skip nulls; the null-safe option does not
    row = one(
        spark.sql("SELECT CAST(NULL AS DOUBLE) AS x").select(
            R.positive_part("x").alias("p"),
            R.positive_part("x", null_safe=True).alias("ps"),
            R.clip("x", hi=3.0).alias("c"),
            R.clip("x", hi=3.0, null_safe=True).alias("cs"),
        )
    )
    assert (row.p, row.ps, row.c, row.cs) == (0.0, None, 3.0, None)


def test_row_stats_ignore_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES (0.2D, 0.4D, 0.9D), (0.5D, NULL, NULL), (NULL, NULL, NULL) AS t(a, b, c)")
    out = df.select(*[e.alias(n) for n, e in R.row_stats(["a", "b", "c"], "s").items()]).collect()
    assert out[0].s_mean == pytest.approx(0.5) and out[0].s_std == pytest.approx(math.sqrt(0.13))
    assert (out[0].s_min, out[0].s_max) == (0.2, 0.9)
    assert (out[1].s_mean, out[1].s_min, out[1].s_max, out[1].s_std) == (0.5, 0.5, 0.5, None)
    assert tuple(out[2]) == (None, None, None, None)


def test_sums_and_flag_counts(spark):
    df = spark.sql("SELECT * FROM VALUES (2, -1, 1), (NULL, 1, 0) AS t(a, b, c)")
    assert [r[0] for r in df.select(R.row_sum(["a", "b", "c"])).collect()] == [2, 1]
    assert [r[0] for r in df.select(R.row_count_flags(["a", "b", "c"])).collect()] == [2, 1]


def test_buckets(spark):
    b = R.Buckets((0, 30), ("none", "late", "very late"), null_label="N/A")
    df = spark.sql("SELECT * FROM VALUES (0), (1), (30), (31), (NULL) AS t(d)")
    rows = df.select(b.label("d").alias("l")).withColumn("r", b.rank("l")).collect()
    assert [tuple(r) for r in rows] == [("none", 0), ("late", 1), ("late", 1), ("very late", 2), ("N/A", 3)]
    without = R.Buckets((0,), ("no", "yes"))
    assert [r[0] for r in df.select(without.label("d")).collect()][-1] == "yes"  # a null falls into the rest
    with pytest.raises(ValueError):
        R.Buckets((1, 2), ("a",))


def test_maps_and_status(spark):
    df = spark.sql("SELECT * FROM VALUES ('Y'), ('N'), ('?'), (NULL) AS t(f)")
    assert [r[0] for r in df.select(R.map_values("f", {"Y": 1, "N": 0})).collect()] == [1, 0, None, None]
    codes = spark.sql("SELECT * FROM VALUES ('0'), ('5'), ('C'), ('X'), (NULL), ('9') AS t(s)")
    assert [r[0] for r in codes.select(R.status_number("s")).collect()] == [0, 5, None, None, None, None]


def test_positive_probability(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0.3, 0.7), [0.3, 0.7], "[0.3, 0.7]"), (Vectors.dense(0.9, 0.1), [0.9], "bad")], ["v", "a", "t"])
    got = [tuple(r) for r in df.select(*[R.positive_probability(df, c) for c in ("v", "a", "t")]).collect()]
    assert got == [(0.7, 0.7, 0.7), (0.1, None, None)]


def test_artifact_type(spark):
    keys = ["x/model_predictions_rf/a", "x/Confusion/a", "x/importance_df/a", "refined/train/a", "zzz/a"]
    df = spark.createDataFrame([(k,) for k in keys], ["key"])
    got = [r[0] for r in df.select(R.artifact_type("key")).collect()]
    assert got == ["model_predictions", "model_metrics", "feature_selection", "refined_data", "other"]


def test_names():
    assert clean_name("  Cash / loans-2 ") == "cash_loans_2"
    assert clean_name("--") == "empty"
    # two values cleaning to one name must not replace each other
    taken = {"t_x"}
    assert value_columns("t", ["A b", "A-b", "x"], taken) == {"A b": "t_a_b", "A-b": "t_a_b_2", "x": "t_x_2"}
    assert business_role("amt_credit") == "credit" and business_role("amt_req_credit_bureau_mon") == "bureau"


def test_years(spark):
    df = spark.sql("SELECT -730 AS d")
    assert values(df.select(R.days_to_years("d"), R.days_to_years("d", "neg"), R.days_to_years("d", "keep"))) == [(2.0, 2.0, -2.0)]
    assert df.select(R.days_to_years("d").alias("y")).schema["y"].dataType.simpleString() == "double"
    assert one(df.select(R.flag(F.col("d") < 0).alias("f"), R.flag(F.lit(None).cast("boolean")).alias("g"))) == (1, 0)
