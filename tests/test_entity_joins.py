from __future__ import annotations

import pytest
from conftest import one, values
from pyspark.sql import functions as F

from creditloom.operators import joins, shaping
from creditloom.operators.entity import Metric, corr_with, duplicates, entity_aggregate
from creditloom.plans import blocks, master, reports


@pytest.fixture()
def facts(spark):
    return spark.sql("SELECT * FROM VALUES (1, 5.0D, 'a', 1), (1, NULL, 'b', 2), (1, 1.0D, 'b', 3), (2, NULL, NULL, 4) AS t(k, x, s, o)")


def test_metric_kinds(spark, facts):
    out = entity_aggregate(
        facts,
        "k",
        [
            Metric("n", "count"), Metric("nx", "count", "x"), Metric("big", "count", where=F.col("x") > 2),
            Metric("sum", "sum", "x"), Metric("sum0", "sum0", "x"), Metric("avg", "avg", "x"), Metric("d", "count_distinct", "s"),
            Metric("share", "share", where=F.col("x") > 2), Metric("pct", "pct", where=F.col("x") > 2),
            Metric("any", "any", where=F.col("x") > 2), Metric("mode", "mode", "s"), Metric("first", "first", "s", order="o"),
            Metric("q", "quantile", "x"),
        ],
    )
    rows = {r.k: r for r in out.collect()}
    assert tuple(rows[1])[1:] == (3, 2, 1, 6.0, 6.0, 3.0, 2, pytest.approx(1 / 3), pytest.approx(100 / 3), 1, "b", "a", 1.0)
    assert tuple(rows[2])[1:] == (1, 0, 0, None, 0.0, None, 0, 0.0, 0.0, 0, None, None, None)


def test_metric_errors(facts):
    with pytest.raises(ValueError):
        entity_aggregate(facts, "k", [Metric("n", "count"), Metric("n", "count")])
    with pytest.raises(ValueError):
        Metric("n", "median").column()
    with pytest.raises(ValueError):
        Metric("n", "first", "s").column()


def test_mode_ties_go_to_the_lowest(spark):
    df = spark.sql("SELECT * FROM VALUES ('b'), ('a'), ('b'), ('a'), (NULL), (NULL), (NULL) AS t(s)")
    assert one(df.agg(Metric("m", "mode", "s").column())).m == "a"


def test_latest_breaks_ties_and_puts_nulls_last(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 5, 1, 'old'), (1, 9, 1, 'x'), (1, 9, 2, 'last'), (1, NULL, 9, 'none'), (2, NULL, 1, 'only') AS t(k, m, tie, s)")
    assert values(shaping.latest_per(df, ["k"], "m", "tie", ["s"])) == [(1, "last"), (2, "only")]


def test_previous_last_status_uses_the_tie_break(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 7L, -3, 'Approved'), (1L, 8L, -3, 'Refused'), (1L, 9L, -90, 'Canceled') AS t(sk_id_curr, sk_id_prev, days_decision, name_contract_status)")
    row = one(blocks.previous_features(df))
    assert (row.prev_last_status, row.prev_num_applications, row.prev_avg_amt_credit) == ("REFUSED", 3, None)


def test_master_keeps_base_rows_and_types_missing_blocks(spark):
    base = spark.sql("SELECT * FROM VALUES (1L, 0), (2L, 1), (3L, 0) AS t(k, target)")
    agg = spark.sql("SELECT * FROM VALUES (1L, 5, 9), (1L, 4, 9), (9L, 1, 1) AS t(k, n, target)")
    out = joins.assemble_master(base, {"a": agg, "b": None}, "k", {"b": {"m": "double"}}, dedupe=["a"])
    assert values(out, "k", "target", "n", "m") == [(1, 0, 4, None), (2, 1, None, None), (3, 0, None, None)]
    assert dict(out.dtypes)["m"] == "double"
    with pytest.raises(ValueError):
        joins.attach(base, agg, "k")  # target is on both sides


def test_client_master_without_any_satellite(spark, sf_dir):
    from creditloom.plans.fixtures import view

    app = view(spark, sf_dir, "fx_application")
    full = master.expected_features(app)
    out = master.client_master(app, {})
    names = [n for block in full.values() for n in block]
    assert set(names) <= set(out.columns) and out.count() == app.count()
    assert out.agg(*[F.count(n) for n in names[:5]]).first() == (0, 0, 0, 0, 0)
    assert all(dict(out.dtypes)[n] == t for block in full.values() for n, t in block.items())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, how):
    hot = spark.range(3000).select((F.when(F.col("id") < 1500, 7).otherwise(F.col("id") % 50)).alias("k"), "id")
    facts = hot.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, -1L AS id"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert joins.hot_keys(facts, "k", 10) == [7]
    assert values(joins.skew_join(facts, lookup, "k", how, 10), "k", "id", "v") == values(facts.join(lookup, "k", how), "k", "id", "v")


def test_balance_block_with_a_hot_credit(spark):
    snaps = spark.range(5000).select(
        F.when(F.col("id") < 3000, 1).otherwise(F.col("id") % 7).alias("sk_id_bureau"),
        (-(F.col("id") % 11)).cast("int").alias("months_balance"),
        F.expr("element_at(array('0', '1', 'c', 'x', NULL), CAST(id % 5 + 1 AS INT))").alias("status"),
    )
    credits = spark.range(6).select(F.col("id").alias("sk_id_bureau"), (F.col("id") % 2).alias("sk_id_curr"))
    got = {r.sk_id_curr: r for r in blocks.balance_features(snaps, credits, blocks.Rounding(None, None, None)).collect()}
    raw = snaps.join(credits, "sk_id_bureau").groupBy("sk_id_curr").agg(
        F.count("*").alias("n"), F.count_distinct("months_balance").alias("m"),
        F.avg((F.upper("status") == "C").cast("int")).alias("unused"), F.count_if(F.coalesce(F.upper("status"), F.lit("X")) == "X").alias("x"),
    )
    for r in raw.collect():
        assert (got[r.sk_id_curr].bb_total_snapshots, got[r.sk_id_curr].bb_num_months, got[r.sk_id_curr].bb_num_status_x) == (r.n, r.m, r.x)


def test_duplicates_and_correlation(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 0, 1.0D), (1, 1, 2.0D), (2, 1, 3.0D) AS t(k, y, x)").withColumn("c", F.lit(1.0))
    assert values(duplicates(df, ["k"])) == [(1, 2)]
    rows = {r.variable: r for r in corr_with(df, "y", ["x", "c"], 6).collect()}
    assert rows["x"].corr_target == pytest.approx(0.866025) and rows["c"].corr_target is None


def test_shares_sum_to_hundred(spark, sf_dir):
    from creditloom.plans.fixtures import view

    out = reports.bucket_distribution(view(spark, sf_dir, "fx_monthly"), F.col("sk_dpd"), reports.DPD)
    rows = out.collect()
    assert sum(r.pct for r in rows) == pytest.approx(100.0)
    assert [r.bucket for r in rows] == [b for b in reports.DPD.order if b in {r.bucket for r in rows}]


def test_pivots_and_top_k(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 0), ('a', 1), ('a', 1), ('b', 0) AS t(s, target)")
    assert values(shaping.pivot_rate(df, "s")) == [("a", 1, 2, pytest.approx(200 / 3)), ("b", 1, 0, 0.0)]
    nums = spark.sql("SELECT * FROM VALUES (1, 5), (2, 5), (3, 4), (4, NULL) AS t(k, n)")
    assert [r.k for r in shaping.top_k(nums, "n", 2, "k").collect()] == [1, 2]
    assert values(shaping.stack_reports([nums, nums.select("n", "k")]).groupBy().count()) == [(8,)]


def test_coverage_classes(spark):
    base = spark.range(4).select(F.col("id").alias("k"))
    a, b = spark.createDataFrame([(0,), (0,), (1,)], "k long"), spark.createDataFrame([(1,), (2,)], "k long")
    assert values(reports.coverage_class(base, {"pos": a, "card": b}, "k")) == [(0, "only pos"), (1, "both"), (2, "only card"), (3, "none")]
