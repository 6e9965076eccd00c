from __future__ import annotations

import pytest
from conftest import values
from pyspark.sql import functions as F

from creditloom.operators import cleaning as C


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], [" SK ID ", "B"])
    assert C.normalize_columns(df).columns == ["sk_id", "b"]
    with pytest.raises(ValueError):
        C.normalize_columns(spark.createDataFrame([(1, 2)], ["A", "a "]))


def test_ensure_columns_are_typed(spark):
    out = C.ensure_columns(spark.range(1), {"id": "bigint", "x": "double", "s": "string"})
    assert dict(out.dtypes) == {"id": "bigint", "x": "double", "s": "string"}
    assert out.first().x is None


def test_header_rows_and_labels(spark):
    df = spark.createDataFrame([("1", "0"), ("SK_ID_CURR", "TARGET"), (None, "1"), ("2", "7"), ("3", "1")], "sk_id_curr string, target string")
    rows = C.drop_header_rows(df, "sk_id_curr")
    assert values(rows, "sk_id_curr") == [("1",), ("2",), ("3",)]
    kept = C.valid_label(df, "target")  # unparseable text must not fail
    assert values(kept) == [("1", 0), ("3", 1), (None, 1)]
    assert dict(kept.dtypes)["target"] == "int"


def test_sentinel_flag_before_null(spark):
    df = spark.sql("SELECT * FROM VALUES (365243), (-5), (NULL) AS t(days_employed)")
    out = C.null_sentinel(df, flag_suffix="_bad")
    assert [tuple(r) for r in out.collect()] == [(None, 1), (-5, 0), (None, 0)]


def test_anomaly_rules(spark):
    df = spark.sql("SELECT * FROM VALUES (0), (-365), (10), (365243), (NULL) AS t(d)")
    out = C.null_anomaly(df, {"d": C.AnomalyRule(lambda c: (c > 0) | (c == 365243), "y"), "absent": C.AnomalyRule(lambda c: c > 0)})
    got = [(r.d, r.d_anom_flag, r.y) for r in out.collect()]
    assert [g[1] for g in got] == [0, 0, 1, 1, 0]
    assert got[1] == (-365, 0, 1.0) and got[0][0] == 0 and got[2][0] is None and got[4][0] is None


def test_sparse_columns_and_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL, 1, NULL), (2, NULL, NULL, 5), (3, 4, 1, 6), (4, 4, 1, 7), (5, NULL, 1, 8) AS t(k, a, b, c)")
    assert C.sparse_columns(df, 0.4) == ["a"]
    assert C.drop_sparse_columns(df, 0.2, keep=["a"]).columns == ["k", "a"]
    empty = spark.sql("SELECT CAST(NULL AS INT) AS k, CAST(NULL AS INT) AS a WHERE 1 = 0")
    assert C.drop_sparse_columns(empty).columns == ["k", "a"]
    rows = spark.sql("SELECT * FROM VALUES (1, NULL, NULL, NULL), (2, 1, NULL, NULL) AS t(k, a, b, c)")
    assert values(C.drop_sparse_rows(rows, 0.7), "k") == [(2,)]


def test_fill_strings(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1), ('  ', 2), (NULL, 3) AS t(s, n)")
    assert [r.s for r in C.fill_strings(df).collect()] == ["a", "UNKNOW", "UNKNOW"]
    assert [r.s for r in C.fill_strings(df, "Unknown", blank=False).collect()] == ["a", "  ", "Unknown"]


def test_category(spark):
    df = spark.sql("SELECT * FROM VALUES ('XNA'), ('xna'), ('F'), (NULL) AS t(g)")
    assert [r.g for r in C.normalize_category(df, "g", {"XNA": "Unknown"}).collect()] == ["Unknown", "Unknown", "F", "Unknown"]
    other = C.category("g", {"f": "Female"}, null_as="none", other="Other", case="upper")
    assert [r[0] for r in df.select(other).collect()] == ["OTHER", "OTHER", "FEMALE", "OTHER"]


@pytest.mark.parametrize("method", ["approx", "exact"])
def test_median_is_fitted_on_train_only(spark, method):
    train = spark.sql("SELECT * FROM VALUES (1.0D, 1), (2.0D, 2), (9.0D, 9), (NULL, NULL) AS t(x, i)")
    test = spark.sql("SELECT * FROM VALUES (NULL, NULL), (500.0D, 500) AS t(x, i)")
    model = C.fit_median(train, ["x", "i"], method)
    assert model.values == {"x": 2.0, "i": 2.0}
    out = C.apply_fill(test, model, flags=True)
    assert values(out, "x", "i", "flag_missing_x") == [(2.0, 2, 1), (500.0, 500, 0)]
    assert dict(out.dtypes)["i"] == "int"


def test_median_of_all_null_column_is_left_out(spark):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 1.0D AS y")
    assert C.fit_median(df).values == {"y": 1.0}
    assert C.fit_median(df, method="exact").values == {"y": 1.0}


def test_medians_of_many_columns_are_not_merged_in_one_task(spark):
    cols = [f"c{i}" for i in range(23)]
    df = spark.range(101).select(*[F.when(F.col("id") % (i + 1) == 0, F.col("id").cast("int") * (1 if i % 2 else 10)).alias(c) for i, c in enumerate(cols)])
    df = df.withColumn("c7", F.lit(None).cast("double"))
    known = {c: r.value for c in cols for r in [df.agg(F.percentile_approx(c, 0.5, 10_000).alias("value")).first()] if r.value is not None}
    model = C.fit_median(df.repartition(3), cols)
    assert model.values == known and list(model.values) == [c for c in cols if c != "c7"]
    assert C.fit_median(df.limit(0), cols).values == {}
    text = C.median_rows(df, cols, 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(place" in text and "SinglePartition" not in text


@pytest.mark.parametrize("first", [1, 2, 3, 100])
def test_constant_columns_among_the_first_rows_only(spark, first):
    df = spark.createDataFrame([(1, 1, None, None, 5), (1, 1, None, None, 5), (1, 2, 3, None, 5)], "same int, late int, half int, none int, k int").coalesce(1)
    assert C.constant_columns(df, first=first) == ["same", "none", "k"]


def test_constant_columns_count_null_as_value(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 7, NULL, 'a'), (2, 7, 3, 'a') AS t(k, same, half, s)").withColumn("none", F.lit(None).cast("int"))
    assert C.constant_columns(df) == ["same", "s", "none"]
    assert C.drop_constant_columns(df, keep=["same"]).columns == ["k", "same", "half"]


def test_clean_table(spark):
    df = spark.createDataFrame([(1, 365243, None, 1.0), (2, -3, None, 2.0), (3, None, 4.0, 3.0)], "`SK_ID_CURR` int, `Days_Employed` int, junk double, ok double")
    out = C.clean_table(df, C.CleanConfig(("sk_id_curr",)))
    assert out.columns == ["sk_id_curr", "ok"]  # both others reach 40 % nulls once the sentinel is null
