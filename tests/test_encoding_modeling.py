from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import one, values
from pyspark.sql import functions as F

from creditloom.operators import encoding as E
from creditloom.operators import modeling as M
from creditloom.plans import master


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(400).select(
        F.col("id").alias("sk_id_curr"),
        (F.col("id") % 10 == 0).cast("int").alias("target"),
        F.expr("CASE WHEN id % 7 = 0 THEN NULL WHEN id % 2 = 0 THEN 'A b' ELSE 'A-b' END").alias("c"),
        F.concat(F.lit("v"), F.col("id") % 30).alias("wide"),
        (F.col("id") % 2).cast("int").alias("bin"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("x"),
    )


def test_one_hot_names_collide_and_rows_sum_to_one(people):
    model = E.fit_one_hot(people, ["c"])
    out = E.apply_one_hot(people, model)
    assert model.columns == ["c_a_b", "c_a_b_2", "c_nan"] and "c" not in out.columns
    assert values(out.select((F.col("c_a_b") + F.col("c_a_b_2") + F.col("c_nan")).alias("s")).distinct()) == [(1,)]


def test_too_many_values_is_an_error_not_a_cut(people):
    with pytest.raises(ValueError):
        E.fit_values(people, ["wide"], limit=10)
    assert len(E.fit_values(people, ["wide"], limit=30)["wide"]) == 30


@pytest.mark.parametrize("limit", [200, 5])
def test_label_index_literal_and_table_agree(people, limit):
    model = E.fit_label_index(people, "wide", literal_limit=limit)
    assert (model.literal is None) == (limit == 5)
    out = E.apply_label_index(people, model, drop=False)
    order = {v: float(i) for i, v in enumerate(sorted(f"v{i}" for i in range(30)))}
    assert all(r.wide_idx == order[r.wide] for r in out.select("wide", "wide_idx").distinct().collect())


def test_label_index_null_rule(spark, people):
    model = E.fit_label_index(people, "c")
    assert model.null_index == 2.0
    no_null = E.fit_label_index(people.filter("c IS NOT NULL"), "c")
    out = E.apply_label_index(people, no_null, drop=False)
    assert values(out.filter("c IS NULL").select("c_idx").distinct()) == [(None,)]
    unseen = spark.createDataFrame([("new",)], "c string")
    assert one(E.apply_label_index(unseen, model)).c_idx is None


def test_encoder_routes_by_cardinality(people):
    model = E.fit_encoder(people, max_ohe=12)
    assert (model.one_hot_columns, model.index_columns) == (["c"], ["wide"])
    assert model.cardinalities == {"c": 2, "wide": 30}
    out = E.apply_encoder(people, model)
    assert not [t for _, t in out.dtypes if t == "string"] and out.count() == 400


def test_caps_keep_nulls_and_types(people):
    caps = E.fit_caps(people, {"x": 0.5, "bin": 0.99})
    out = E.apply_caps(people, caps)
    assert dict(out.dtypes)["bin_cap"] == "int"
    row = one(out.agg(F.max("x_cap").alias("m"), F.count("x_cap").alias("n"), F.count("x").alias("nx")))
    assert row.m == caps.bounds["x"] and row.n == row.nx
    assert E.fit_caps(people, {"x": 0.5}, "exact").bounds["x"] == caps.bounds["x"]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_split_is_disjoint_complete_and_independent_of_partitions(people, method):
    train, test = E.hash_split(people, "sk_id_curr", 0.8, method=method)
    a, b = set(r[0] for r in train.select("sk_id_curr").collect()), set(r[0] for r in test.select("sk_id_curr").collect())
    assert not a & b and len(a | b) == 400 and 280 < len(a) < 360
    again, _ = E.hash_split(people.repartition(7), "sk_id_curr", 0.8, method=method)
    assert a == set(r[0] for r in again.select("sk_id_curr").collect())


def test_stratified_split_keeps_class_shares(people):
    out = E.stratified_split(people, "target", "sk_id_curr", 0.75)
    got = {r.target: (r.n, r.t) for r in out.groupBy("target").agg(F.count("*").alias("n"), F.count_if("in_train").alias("t")).collect()}
    assert got == {0: (360, 270), 1: (40, 30)}


def test_class_weights_balance(people):
    out = E.class_weights(people.withColumn("label", F.col("target").cast("double")))
    sums = {r.label: r.s for r in out.groupBy("label").agg(F.sum("class_weight").alias("s")).collect()}
    assert sums[0.0] == pytest.approx(200.0) and sums[1.0] == pytest.approx(200.0)


def test_category_shares_count_nulls_in_the_denominator(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (1, NULL), (1, 'a') AS t(k, c)")
    assert values(E.category_shares(df, "k", ["c"])) == [(1, 0.5, 0.25)]


def test_ml_pipeline_handles_empty_and_missing(spark, people):
    out = E.ml_ready(people.withColumn("none", F.lit(None).cast("double")))
    assert out.count() == 400 and out.columns == ["sk_id_curr", "label", "features"]
    bare = E.ml_ready(people.select("sk_id_curr", "target"))
    assert bare.first().features.toArray().tolist() == [1.0]


def test_forest_round(people):
    rows = people.withColumn("label", F.col("target").cast("double")).withColumn("signal", F.col("target") * 5.0)
    cols = M.feature_columns(rows)
    train, test = E.hash_split(rows, "sk_id_curr")
    model = M.fit_forest(E.class_weights(M.assemble(train, cols, "median")), M.ForestParams(trees=5, depth=3), weight="class_weight")
    scored = M.score(model, M.assemble(test, cols, "median", train=train))
    assert scored.columns == ["sk_id_curr", "target", "label", "prediction", "probability"]
    got = {r.metric: r.value for r in M.metrics(scored, score_col="probability").collect()}
    assert got["auc"] > 0.99 and got["recall"] == 1.0
    assert M.importance(model, cols, rows).first().feature == "signal"
    assert one(M.confusion_report(scored).agg(F.sum("count").alias("n"), F.sum("pct_of_total").alias("p"))) == (test.count(), pytest.approx(100.0))


def test_metrics_without_positives(spark):
    df = spark.sql("SELECT 0.0D AS label, 0.0D AS prediction")
    got = {r.metric: r.value for r in M.metrics(df).collect()}
    assert got == {"accuracy": 1.0, "precision": None, "recall": None, "f1_score": None}


def test_ranking_separates_binary_and_continuous(people):
    rank = {r.feature: r for r in M.rank_features(people.withColumn("mid", F.col("bin") * 0.5 + F.col("target") * 0.25)).collect()}
    assert {f: r.kind for f, r in rank.items()} == {"bin": "binary", "x": "continuous", "mid": "continuous"}
    table = one(M.chi_square_table(people, ["bin"]))
    assert rank["bin"].value == pytest.approx(table.statistic)
    x = people.fillna(0, ["x"]).toPandas()
    assert rank["x"].value == pytest.approx(np.corrcoef(x["x"], x["target"])[0, 1]) and rank["x"].strength == abs(rank["x"].value)


def test_chi_square_tail(spark):
    statistics = [0.0, 1e-6, 0.3, 3.841458820694124, 50.0, 700.0, 5000.0]
    p, digits = M.chi_square_tail(F.col("s"))
    rows = spark.createDataFrame([(s,) for s in statistics], "s double").select("s", p.alias("p"), digits.alias("d")).collect()
    for r in rows:
        assert r.p == pytest.approx(math.erfc(math.sqrt(r.s / 2)), rel=2e-7)
    assert rows[-1].p == 0 and rows[-1].d == pytest.approx(2500 / math.log(10) + 0.5 * math.log10(math.pi * 2500), rel=1e-4)


def test_sample_and_split_do_not_depend_on_partitions(spark):
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 300).alias("c")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 7L AS c"))
    assert values(E.sample(rows, "k", 0.2)) == values(E.sample(rows.repartition(7), "k", 0.2))
    marked = E.stratified_split(rows, "c", "k", 0.5, method="md5")
    assert marked.filter("in_train IS NULL").isEmpty() and one(marked.filter("k IS NULL")).in_train
    assert E.class_weights(rows, "c").agg(F.round(F.sum("class_weight"), 6).alias("s")).first().s == 2001.0
    shares = E.long_shares(rows.withColumn("g", F.lit(1)), "g", ["c"])
    assert shares.count() == 300 and one(shares.agg(F.sum("share").alias("s"))).s == pytest.approx(1.0)
    assert len(E.fit_values(rows, ["c"])["c"]) == 300


def test_application_features_invariants(spark, sf_dir):
    from creditloom.plans.fixtures import view

    app = view(spark, sf_dir, "fx_application")
    out = master.application_features(app).cache()
    assert out.count() == app.count() and "flag_document_2" not in out.columns
    hot = [c for c in out.columns if c.startswith("code_gender_")]
    assert values(out.select(sum(F.col(c) for c in hot).alias("s")).distinct()) == [(1,)]
    assert one(out.agg(F.count_if(F.col("amt_credit_cap") > F.col("amt_credit")).alias("n"))).n == 0
    plain = master.application_features(app, master.FeatureConfig(one_hot=False, drop_constant=False, drop_document_flags=True))
    assert "code_gender" in plain.columns and not [c for c in plain.columns if c.startswith("flag_document_")]
