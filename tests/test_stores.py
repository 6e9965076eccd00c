"""Stored blocks, merged sketches, node tables, contracts and the shared folder."""

from __future__ import annotations

import random

import pytest
from conftest import SF_DIR, one, values
from pyspark.sql import functions as F

from creditloom import shared
from creditloom.functions import sketches as K
from creditloom.functions.quantiles import exact_quantiles
from creditloom.operators import encoding as E
from creditloom.operators import modeling as M
from creditloom.operators import treetable as TT
from creditloom.plans import blocks, forest, master
from creditloom.plans.blocks import KEY
from creditloom.plans.fixtures import view
from creditloom.sources import contracts as C
from creditloom.sources.blockstore import BlockStore
from creditloom.sources.sketchstore import SketchStore, sketch_report


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    made = BlockStore(spark, str(tmp_path), f"b{random.getrandbits(40):x}", KEY, 3)
    yield made
    made.drop()


@pytest.fixture
def tables(spark):
    names = {
        "bureau": "fx_bureau", "bureau_balance": "fx_bureau_balance", "previous_application": "fx_previous",
        "installments_payments": "fx_installments", "pos_cash_balance": "fx_monthly", "credit_card_balance": "fx_monthly",
    }
    return {k: view(spark, SF_DIR, v) for k, v in names.items()}


def test_stored_master_moves_nothing(spark, store, tables):
    application = view(spark, SF_DIR, "fx_application")
    assert master.store_blocks(store, application, tables) == [master.BASE, *tables]
    out = master.stored_master(store)
    text = plan(out)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 6 and text.count("Bucketed: true") == 7
    direct = master.client_master(application, tables)
    assert out.columns == direct.columns and values(out) == values(direct)


def test_one_block_is_refreshed_alone(spark, store, tables):
    application = view(spark, SF_DIR, "fx_application")
    master.store_blocks(store, application, {**tables, "credit_card_balance": None})
    before = {n: store.current(n) for n in store.names()}
    assert "credit_card_balance" not in before
    out = master.stored_master(store)
    assert out.schema["cc_avg_balance"].dataType.simpleString() == "double" and one(out.agg(F.count("cc_avg_balance").alias("n"))).n == 0
    reader = store.read("bureau")
    fewer = tables["bureau"].filter("sk_id_curr % 2 = 0")
    assert master.store_blocks(store, None, {"bureau": fewer}) == ["bureau"]
    after = {n: store.current(n) for n in store.names()}
    assert {n for n in after if before[n] != after[n]} == {"bureau"}
    assert reader.count() > store.read("bureau").count() == blocks.bureau_features(fewer).count()
    assert store.versions().filter("NOT is_current").count() == 1 and store.vacuum() == 1 and store.vacuum() == 0
    assert store.versions().count() == len(after)


def test_block_files_hold_one_bucket_each(spark, store):
    store.write("numbers", spark.range(100).select(F.col("id").alias(KEY), F.col("id").alias("n")).repartition(7))
    files = spark.table(f"{store.database}.{store.current('numbers')}").groupBy("_metadata.file_name").agg(F.count("*").alias("n"))
    assert files.count() == 3 and store.read("numbers").count() == 100
    empty = spark.range(0).select(F.col("id").alias(KEY), F.col("id").alias("m"))
    store.write("nothing", empty)
    assert store.assemble("numbers", ["nothing"]).filter("m IS NULL").count() == 100


def test_block_store_refuses(spark, store, tmp_path):
    for name in ("Upper", "a b", "x__v1", ""):
        with pytest.raises(ValueError):
            store.write(name, spark.range(1).withColumnRenamed("id", KEY))
    with pytest.raises(LookupError):
        store.assemble("absent", [])
    with pytest.raises(ValueError):
        BlockStore(spark, str(tmp_path), "z", KEY, 0)


def test_failed_write_leaves_the_block(spark, store):
    rows = spark.range(5).select(F.col("id").alias(KEY), F.lit(1).alias("n"))
    store.write("numbers", rows)
    with pytest.raises(Exception):
        store.write("numbers", rows.withColumn("n", F.raise_error(F.lit("no")).cast("int")))
    assert store.read("numbers").agg(F.sum("n")).first()[0] == 5


def test_sketches_merge_exactly_when_small(spark):
    rows = spark.range(900).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 300).cast("double").alias("x"), (F.col("id") % 5).alias("load"))
    parts = rows.groupBy("g", "load").agg(K.value_sketch("x").alias("s"))
    got = parts.groupBy("g").agg(K.merged_sketch("s").alias("s")).select("g", K.sketched_quantile("s", [0.1, 0.5, 1.0]).alias("q"), K.sketched_count("s").alias("n"))
    expected = {r.g: r.q for r in rows.groupBy("g").agg(F.expr("array(" + ", ".join(f"percentile_disc({q}) WITHIN GROUP (ORDER BY x)" for q in (0.1, 0.5, 1.0)) + ")").alias("q")).collect()}
    assert {r.g: r.q for r in got.collect()} == expected and {r.n for r in got.collect()} == {300}


def test_sketch_of_nothing(spark):
    empty = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x")
    row = one(empty.agg(K.value_sketch("x").alias("s")).select(K.sketched_count("s").alias("n"), K.sketched_quantile("s", 0.5).alias("q"), K.sketched_rank("s", F.lit(1.0)).alias("r")))
    assert (row.n, row.q, row.r) == (0, None, None)


def test_sketch_error_is_as_stated(spark, tmp_path):
    rows = spark.range(200_000).select(((F.col("id") * 104_729) % 199_999).cast("double").alias("x"), (F.col("id") % 8).alias("load"), F.when(F.col("id") % 3 > 0, 1.0).alias("y"))
    store = SketchStore(spark, str(tmp_path / "s"), (), ("x", "y"), size=200)
    for i in range(8):
        store.append(f"{i:02d}", rows.filter(F.col("load") == i), {"x": F.col("x"), "y": F.col("y")})
    report = sketch_report(store.merged(), rows, {"x": F.col("x"), "y": F.col("y")}, [0.01, 0.5, 0.9], size=200).collect()
    assert len(report) == 6 and all(r.within for r in report) and max(r.rank_error for r in report) <= K.rank_error(200) < 0.0134
    assert one(store.merged(since="02", upto="04").select("loads")).loads == 3
    assert len(list((tmp_path / "s").glob("load_id=*"))) == 8
    store.compact("all")
    assert one(store.merged().select("loads", K.sketched_count("x").alias("n"))) == (1, 200_000)
    wrong = sketch_report(store.merged(), rows.withColumn("x", F.col("x") * 2), {"x": F.col("x")}, [0.5], size=200)
    assert not one(wrong).within


def test_a_load_counts_once(spark, tmp_path):
    store = SketchStore(spark, str(tmp_path / "s"), ("k",), ("x",))
    with pytest.raises(LookupError):
        store.merged()
    rows = spark.sql("SELECT * FROM VALUES (1, 1.0D), (1, 9.0D), (NULL, 4.0D), (2, NULL) t(k, x)")
    for load in ("01", "02", "01"):
        store.append(load, rows, {"x": F.col("x")})
    assert values(store.quantiles(0.5)) == values(spark.sql("SELECT * FROM VALUES (1, 1.0D), (NULL, 4.0D), (2, NULL) t(k, x_median)"))
    assert {r.n for r in store.merged().select(K.sketched_count("x").alias("n")).collect()} == {4, 2, 0}
    with pytest.raises(ValueError):
        store.append("03", rows, {"z": F.col("x")})


@pytest.mark.parametrize("last", [1, 7, 1000, None])
@pytest.mark.parametrize("kind", ["disc", "cont"])
def test_quantiles_are_exact_however_narrow_the_last_interval(spark, last, kind):
    n = 3000
    rows = spark.range(n).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 997).cast("double").alias("x"), F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("y"))
    qs = [0.0, 0.01, 0.5, 0.77, 1.0]
    got = {(r.g, r.variable, r.q): r.value for r in exact_quantiles(rows, ["x", "y"], qs, ["g"], kind, accuracy=50, last=last).collect()}
    for c in ("x", "y"):
        for q in qs:
            for r in rows.groupBy("g").agg(F.expr(f"percentile_{kind}({q}) WITHIN GROUP (ORDER BY {c})").alias("v")).collect():
                assert got[r.g, c, q] == pytest.approx(r.v, abs=1e-9), (c, q, r.g)
    assert exact_quantiles(rows.limit(0), ["x"], [0.5], last=last).count() == 0


def roc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 2, 5, 256])
def test_auc_is_exact_for_any_number_of_buckets(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(2), rng.choice([rng.random(), 0.5, 0.25, None])) for _ in range(600)] + [("one", 1, 0.5), ("none", None, 0.5), ("a", 7, 0.1)]
    df = spark.createDataFrame(rows, "g string, y int, s double").repartition(5)
    lazy = M.auc_table(df, "y", "s", ["g"], buckets)
    got = {r.g: (r.positives, r.negatives, r.auc) for r in lazy.collect()}
    for g in ("a", "b", None, "one"):
        part = [(y, s) for k, y, s in rows if k == g and y in (0, 1) and s is not None]
        assert got[g][:2] == (sum(y for y, _ in part), sum(1 - y for y, _ in part))
        assert got[g][2] == (None if roc(part) is None else pytest.approx(roc(part), abs=1e-12))
    assert "none" not in got
    whole = [(y, s) for _, y, s in rows if y in (0, 1) and s is not None]
    assert M.auc(df, "y", "s") == pytest.approx(roc(whole), abs=1e-12)
    assert tuple(one(M.auc_table(df.limit(0), "y", "s"))) == (0, 0, None)


def test_auc_sorts_no_table_in_one_task(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("y"), F.col("id").cast("double").alias("s"))
    text = plan(M.auc_table(df, "y", "s"))
    assert "Window [" not in text or "_bucket" in text.split("Window [", 1)[1].split("\n", 1)[0]
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.fixture(scope="module")
def learned(spark, tmp_path_factory):
    rows = spark.range(1500).select(
        F.col("id").alias(KEY), ((F.col("id") * 7919) % 100).cast("double").alias("a"), ((F.col("id") * 613) % 50).cast("double").alias("b"),
        F.when(F.col("id") % 9 > 0, (F.col("id") % 7).cast("double")).alias("c"),
    )
    rows = rows.withColumn("target", F.when((F.col("a") > 60) & (F.col("b") < 30), 1).otherwise(0))
    params = M.ForestParams(trees=8, depth=5)
    folder = str(tmp_path_factory.mktemp("forest"))
    return rows, params, forest.train(rows, folder, params), folder


def test_node_table_scores_like_the_model(spark, learned):
    _, params, f, _ = learned
    known = dict(zip(f.columns, f.model.featureImportances.toArray()))
    found = {r.feature: r.importance for r in TT.importance_table(f.nodes, f.columns).collect()}
    assert found == {c: pytest.approx(v, abs=1e-9) for c, v in known.items()} and found["a"] > found["c"]
    walked = {r[KEY]: (r.p, r.prediction) for r in TT.score_by_nodes(f.scored, f.nodes, params.trees, params.depth, KEY).collect()}
    assert len(walked) == f.scored.count()
    for r in f.scored.collect():
        assert walked[r[KEY]] == (pytest.approx(r.p, abs=1e-12), r.prediction)
    shapes = TT.forest_shape(f.nodes, params.depth).collect()
    assert len(shapes) == 8 and all(s.depth <= 5 and s.leaves * 2 - 1 == s.nodes for s in shapes)
    text = plan(TT.score_by_nodes(f.scored, f.nodes, params.trees, params.depth, KEY))
    assert "SortMergeJoin" not in text and "NestedLoop" not in text


def test_scoring_after_an_observed_write(spark, learned, tmp_path):
    from creditloom.sources.storage import Catalog, OutputRegistry, write_parquet

    rows, _, _, _ = learned
    write_parquet(spark.range(3), Catalog(str(tmp_path)), "refined", "t", registry=OutputRegistry())
    vectors = M.assemble(rows.withColumn("label", F.col("target").cast("double")), ["a", "b"], "zero")
    assert M.score(M.fit_forest(vectors, M.ForestParams(trees=2, depth=2)), vectors).count() == 1500


def test_forest_separates_and_repeats(spark, learned):
    rows, params, f, folder = learned
    metrics = {r.metric: r.value for r in M.metrics(f.scored, score_col="p").collect()}
    assert metrics["auc"] > 0.97 and metrics["recall"] > 0.9 and 0 <= metrics["precision"] <= 1
    again = forest.train(rows.repartition(9), folder, params)
    columns = ["tree", "node", "feature", "threshold", "gain", "weight"]
    assert values(again.nodes.select(*columns)) == values(f.nodes.select(*columns))


def test_forest_makes_its_features_once(spark, learned, tmp_path):
    rows, params, f, _ = learned
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    again = forest.train(rows.mapInArrow(count, rows.schema), str(tmp_path), params)
    assert made.value == 1500
    assert values(again.scored, KEY, "p") == values(f.scored, KEY, "p")


def test_vector_entries(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1, Vectors.sparse(4, [1, 3], [2.0, 0.0])), (2, Vectors.dense([0.0, -1.0, 0.0, 5.0])), (3, Vectors.sparse(4, [], []))]
    df = spark.createDataFrame(rows, ["k", "features"])
    assert values(E.vector_entries(df, ["k"])) == [(1, 1, "1", 2.0), (2, 1, "1", -1.0), (2, 3, "3", 5.0)]
    assert E.vector_entries(df, ["k"], keep_zeros=True).count() == 12
    people = spark.sql("SELECT * FROM VALUES (1, 0, 'a b', 2.0D), (2, 1, NULL, NULL) t(sk_id_curr, target, c, x)")
    entries = values(E.vector_entries(E.ml_ready(people), ["sk_id_curr"]).select("sk_id_curr", "name", "value"))
    assert entries == [(1, "c_ohe_a b", 1.0), (1, "x_imp", 2.0), (2, "c_ohe_Unknown", 1.0), (2, "x_imp", 2.0)]


def test_fitted_pipeline_fills_other_rows(spark):
    train = spark.sql("SELECT * FROM VALUES (1, 0, 1.0D, 'a'), (2, 1, 3.0D, 'b'), (3, 0, CAST('NaN' AS DOUBLE), 'a') t(sk_id_curr, target, x, c)")
    model, _ = E.ml_pipeline(train)
    other = spark.sql("SELECT 9 AS sk_id_curr, 0 AS target, CAST(NULL AS DOUBLE) AS x, 'new' AS c")
    filled = {r.name: r.value for r in E.vector_entries(model.transform(other), ["sk_id_curr"]).collect()}
    assert filled["x_imp"] == 1.0


def test_frequent_values_and_the_rest(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 11).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("warm")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("c"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("d"),
    )
    found = E.frequent_values(rows, ["c", "d"], 0.01)
    exact = {r.c: r.n for r in rows.groupBy("c").agg(F.count("*").alias("n")).filter("n >= 200").collect()}
    assert found == {"c": exact, "d": {"x": 10_000}} and set(exact) == {"hot", "warm"}
    wide, rest = E.split_shares(rows, "k", ["c", "d"], 0.01)
    assert wide.columns == ["k", "c_hot", "c_warm", "d_x"]
    everything = E.long_shares(rows, "k", ["c", "d"])
    kept = everything.join(spark.createDataFrame([("c", "hot"), ("c", "warm"), ("d", "x")], "variable string, value string"), ["variable", "value"], "left_anti")
    assert values(rest, "k", "variable", "value", "share") == values(kept, "k", "variable", "value", "share")
    with pytest.raises(ValueError):
        E.frequent_values(rows, ["c"], 0.0)
    with pytest.raises(ValueError):
        E.frequent_values(rows, ["c"], 1e-6)
    with pytest.raises(ValueError):
        E.fit_values(rows, ["c"])
    assert E.frequent_values(rows.limit(0), ["c"]) == {"c": {}} and E.frequent_values(rows, []) == {}


def test_malformed_values(spark, tmp_path):
    schema = C.schema_from_pairs({"A": "int", "B": "double", "C": "string", "D": "bigint"})
    (tmp_path / "x.csv").write_text("a,b,c\n1,2.5,x\n 2 ,nan?,\n1.5,,y,extra\n,1e3,\nz9\n")
    text = C.read_text_columns(spark, str(tmp_path / "x.csv"), ["a", "b", "c"])
    got = {r.column: (r.declared, r.rows, r.blank, r.malformed, r.example) for r in C.malformed_values(text, schema).collect()}
    assert got == {"a": ("int", 5, 1, 2, "1.5"), "b": ("double", 5, 2, 1, "nan?"), "c": ("string", 5, 3, 0, None), "d": ("bigint", 5, 5, 0, None)}
    assert tuple(one(C.line_faults(text))) == (5, 2, 0)
    assert values(C.apply_contract(text, schema)) == values(spark.sql("SELECT * FROM VALUES (1, 2.5D, 'x', NULL), (2, NULL, NULL, NULL), (NULL, NULL, 'y', NULL), (NULL, 1000D, NULL, NULL), (NULL, NULL, NULL, NULL) t(a, b, c, d)"))
    assert C.malformed_values(text, C.schema_from_pairs({})).count() == 0
    assert plan(C.malformed_values(text, schema)).count("FileScan") == 1


class Session:
    """What ``shared_folder`` asks a session."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: conf.get(k.replace(".", "_"), d))})


def test_shared_folder_is_shared():
    own = {"spark_sql_warehouse_dir": "file:/home/w"}
    assert shared.shared_folder(Session("local[4]", **own)) == "file:/home/w/_shared"
    assert shared.shared_folder(Session("yarn", spark_sql_warehouse_dir="s3a://lake/w/")) == "s3a://lake/w/_shared"
    assert shared.shared_folder(Session("yarn", spark_checkpoint_dir="hdfs://x/c/", **own)) == "hdfs://x/c"
    for master_url in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared.shared_folder(Session(master_url, **own))
