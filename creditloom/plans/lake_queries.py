"""Named queries over what is written first: block and sketch stores, stored
models, contracts on raw text, catalog tables, sinks and artifacts.

All input comes from the test tables; what a query writes goes to a folder of
its own below the shared one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import artifact_type
from creditloom.operators import encoding, modeling, profiling, treetable
from creditloom.plans import blocks, forest, master
from creditloom.plans.blocks import KEY
from creditloom.plans.fixtures import SPARK_DAYS, view
from creditloom.plans.queries import ALL_VIEWS, FINE, FINE_SKETCH, QUERIES, query, satellites
from creditloom.shared import shared_folder
from creditloom.sources import artifacts, contracts, storage
from creditloom.sources.blockstore import BlockStore
from creditloom.sources.sketchstore import SketchStore, sketch_report


def own_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def lake_query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a function of the session and the data folder under its name."""
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- stored blocks ----------------------------------------------------------


def _block_store(spark: SparkSession) -> BlockStore:
    name = f"blocks_{uuid.uuid4().hex[:12]}"
    return BlockStore(spark, shared_folder(spark), name, KEY, int(spark.conf.get("spark.sql.shuffle.partitions")))


@query(*ALL_VIEWS)
def client_master_bucketed(application, *rest):
    """The master from bucketed blocks, joined without an exchange."""
    store = _block_store(application.sparkSession)
    master.store_blocks(store, application, satellites(*rest), FINE, accuracy=FINE_SKETCH)
    return master.stored_master(store)


@query(*ALL_VIEWS)
def client_master_refreshed(application, *rest):
    """A first load that knew only older credits and no card months; then
    these blocks are written again, alone, and old versions dropped."""
    store = _block_store(application.sparkSession)
    tables = satellites(*rest)
    older = tables["bureau"].filter(F.col("days_credit") < -1000)
    first = {**tables, "bureau": older, "credit_card_balance": None}
    master.store_blocks(store, application, first, FINE, accuracy=FINE_SKETCH)
    late = {"bureau": tables["bureau"], "bureau_balance": tables["bureau_balance"], "credit_card_balance": tables["credit_card_balance"]}
    master.store_blocks(store, None, late, FINE)
    store.vacuum()
    return master.stored_master(store)


# --- merged sketches --------------------------------------------------------


@query("fx_previous")
def sketch_previous_medians(previous):
    """Medians per client merged from sketches of yearly loads, one of
    which was loaded twice."""
    columns = ("days_decision", "amt_application", "amt_credit", "amt_annuity", "amt_goods_price", "cnt_payment")
    store = SketchStore(previous.sparkSession, own_folder(previous.sparkSession, "sketches"), (KEY,), columns)
    year = F.floor(F.col("days_decision") / 365)
    limits = [(None, -4), (-4, -2), (-2, None)]
    for name, (low, high) in zip(("a", "b", "c", "b"), [*limits, limits[1]]):
        part = previous.filter((year >= low if low is not None else F.lit(True)) & (year < high if high is not None else F.lit(True)))
        store.append(name, part, {c: F.col(c) for c in columns})
    return store.quantiles()


@query("fx_installments")
def sketch_behaviour_medians(installments):
    """Median days past due and payment ratio per client from two
    loads that are then compacted to one."""
    rows = blocks._behaviour_rows(installments, null_safe=False)
    spark = installments.sparkSession
    store = SketchStore(spark, own_folder(spark, "sketches"), (KEY,), ("dpd", "payment_ratio"))
    values = {"dpd": F.col("_dpd"), "payment_ratio": F.col("_ratio")}
    early = F.col("num_instalment_number") <= 3
    store.append("early", rows.filter(early), values)
    store.append("late", rows.filter(~early), values)
    store.compact("whole")
    return store.quantiles()


@query("fx_installments")
def sketch_accuracy(installments):
    """Merged sketches of a whole table against its rows; ``within`` says
    that the true rank lies inside the stated error."""
    values = {"amt_instalment": F.col("amt_instalment"), "amt_payment": F.col("amt_payment"), "days_entry_payment": F.col("days_entry_payment")}
    spark = installments.sparkSession
    store = SketchStore(spark, own_folder(spark, "sketches"), (), tuple(values), size=200)
    for number in range(1, 8):
        store.append(f"{number}", installments.filter(F.col("num_instalment_number") == number), values)
    merged = store.merged()
    report = sketch_report(merged, installments, values, [0.01, 0.25, 0.5, 0.75, 0.99], size=200)
    return report.crossJoin(F.broadcast(merged.select("loads"))).select("measure", "q", "n", "loads", "within")


# --- stored model -----------------------------------------------------------


@lake_query
def forest_metrics(spark, sf_dir):
    """M2, M3, M6, M7: the weighted forest of 50 trees on the features of E23,
    evaluated on the held-out split."""
    return modeling.metrics(forest.forest_of(spark, sf_dir).scored, score_col="p")


@lake_query
def forest_confusion(spark, sf_dir):
    return modeling.confusion_report(forest.forest_of(spark, sf_dir).scored)


@lake_query
def importance(spark, sf_dir):
    """M4: importance from the table of nodes."""
    f = forest.forest_of(spark, sf_dir)
    return treetable.importance_table(f.nodes, f.columns)


@lake_query
def forest_nodes(spark, sf_dir):
    """M3: size of every tree, from the table of nodes."""
    f = forest.forest_of(spark, sf_dir)
    return treetable.forest_shape(f.nodes, f.params.depth)


@lake_query
def forest_checks(spark, sf_dir):
    """M2-M4: the stored forest held against itself and the tables.

    Every row is ``check, n, passed``; ``n`` counts what was looked at where the
    tables say how much that is.
    """
    f = forest.forest_of(spark, sf_dir)
    nodes, scored, model = f.nodes, f.scored, f.model
    trees = treetable.forest_shape(nodes, f.params.depth)
    walked = treetable.score_by_nodes(scored, nodes, f.params.trees, f.params.depth, KEY).select(KEY, F.col("p").alias("_p"), F.col("prediction").alias("_prediction"))
    met = scored.join(walked, KEY, "left")
    children = nodes.select("tree", F.col("node").alias("child"), F.col("node").alias("_found"))
    below = nodes.filter(F.col("left").isNotNull()).select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    pairs = below.join(children, ["tree", "child"], "left").groupBy("tree", "node").agg(F.count("_found").alias("_children"))
    known = [(c, float(v)) for c, v in zip(f.columns, model.featureImportances.toArray(), strict=True)]
    importances = treetable.importance_table(nodes, f.columns).join(spark.createDataFrame(known, "feature string, known double"), "feature", "full")
    none = F.lit(None).cast("long")

    def check(name, df, n, passed):
        return df.agg(n.cast("long").alias("n"), F.coalesce(passed, F.lit(False)).alias("passed")).select(F.lit(name).alias("check"), "n", "passed")

    one = F.count(F.lit(1))
    return profiling.stack_reports(
        [
            check("trees no deeper than asked", trees, one, F.max("depth") <= f.params.depth),
            check("every split has both children", pairs, none, F.every(F.col("_children") == 2)),
            check("importance equals the model's", importances, none, F.max(F.abs(F.col("importance") - F.col("known"))) < 1e-9),
            check("importance adds up to one", importances, none, F.abs(F.sum("importance") - 1) < 1e-9),
            check("walking the nodes scores like the model", met, one, F.every((F.abs(F.col("p") - F.col("_p")) < 1e-9) & (F.col("prediction") == F.col("_prediction")))),
            check("held-out defaults", met.filter(F.col("target") == 1), one, F.lit(True)),
        ]
    )


@query("fx_application")
def score_auc(application):
    """M6: area under the ROC curve of a score with ties, as one lazy aggregate."""
    scored = application.select(F.col("target").cast("double").alias("label"), (F.col("amt_income_total") / 2e5 + F.col("sk_id_curr") % 3).alias("probability"))
    return modeling.auc_table(scored).select(F.round("auc", 6).alias("auc"))


@query("fx_application")
def grouped_auc(application):
    """M6: area per group, with ties, missing scores and a null group."""
    score = F.round(F.col("ext_source_2"), 1)
    scored = application.select("name_education_type", "target", score.alias("score"))
    return modeling.auc_table(scored, "target", "score", ["name_education_type"], buckets=16).withColumn("auc", F.round("auc", 9))


@query("fx_application")
def ml_ready_entries(application):
    """Every non-zero entry of the assembled vectors, by slot name."""
    ready = encoding.ml_ready(master.application_base(application, accuracy=FINE_SKETCH))
    return encoding.vector_entries(ready, [KEY, "label"]).select(KEY, "label", "name", F.round("value", 9).alias("value"))


# --- values that become columns ---------------------------------------------

SHARE_COLUMNS = ["name_client_type", "name_contract_status", "cnt_payment", "sellerplace_area", "days_decision"]


@query("fx_previous")
def frequent_values(previous):
    """Values that at least 3 % of the rows have, with exact counts."""
    found = encoding.frequent_values(previous, SHARE_COLUMNS, 0.03)
    rows = [(c, v, n) for c, values in found.items() for v, n in values.items()]
    return previous.sparkSession.createDataFrame(rows, "variable string, value string, n long")


@query("fx_previous")
def split_shares(previous):
    """Frequent values as columns and all others as rows; put together
    again here, they are the shares of every value."""
    wide, rest = encoding.split_shares(previous, KEY, SHARE_COLUMNS, 0.03)
    frequent = encoding.frequent_values(previous, SHARE_COLUMNS, 0.03)
    names = [c for c in wide.columns if c != KEY]
    held = [(c, v) for c, values in frequent.items() for v in values]
    lookup = previous.sparkSession.createDataFrame([(n, c, v) for n, (c, v) in zip(names, held, strict=True)], "column string, variable string, value string")
    long = wide.unpivot([KEY], names, "column", "share").filter(F.col("share") > 0).join(F.broadcast(lookup), "column")
    both = long.select(KEY, "variable", "value", "share", F.lit("column").alias("placed")).unionByName(rest.withColumn("placed", F.lit("rows")))
    return both.withColumn("share", F.round("share", 9))


# --- contracts on raw text --------------------------------------------------

# A credit table as a raw file delivers it. Some amounts and days
# are words, some are blank, and some lines have a field too many.
RAW_CREDITS = {
    "sk_id_bureau": "CAST(o_orderkey AS STRING)",
    "days_credit": f"CASE WHEN o_orderkey % 50 = 7 THEN 'n/a' WHEN o_orderkey % 31 = 0 THEN '' ELSE CAST({SPARK_DAYS} AS STRING) END",
    "amt_credit_sum": "CASE WHEN o_orderkey % 77 = 5 THEN 'unknown' WHEN o_orderkey % 13 = 1 THEN ' ' ELSE CAST(o_totalprice AS STRING) END",
    "credit_active": "CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE o_orderstatus END",
}
CREDIT_CONTRACT = [
    {"Name": "SK_ID_BUREAU", "Type": "bigint"}, {"Name": "DAYS_CREDIT", "Type": "int"}, {"Name": "AMT_CREDIT_SUM", "Type": "double"},
    {"Name": "CREDIT_ACTIVE", "Type": "string"}, {"Name": "CREDIT_TYPE", "Type": "string"},
]


def _raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in RAW_CREDITS.items()])


def _raw_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw credits written as plain lines and read back as text columns."""
    path = own_folder(spark, "raw")
    stray = F.when(F.col("sk_id_bureau").cast("long") % 101 == 0, F.lit(",stray")).otherwise(F.lit(""))
    rows = _raw_credits(spark, sf_dir)
    rows.select(F.concat(F.concat_ws(",", *rows.columns), stray).alias("value")).write.text(path)
    return contracts.read_text_columns(spark, path, list(RAW_CREDITS), header=False)


def _contract(spark: SparkSession):
    """The declared schema, from a JSON file."""
    path = own_folder(spark, "contract")
    spark.createDataFrame([(json.dumps(CREDIT_CONTRACT),)], "value string").coalesce(1).write.text(path)
    return contracts.schema_from_json(spark, path)


@lake_query
def contract_malformed(spark, sf_dir):
    """Blank and malformed values per declared column."""
    out = contracts.malformed_values(_raw_file(spark, sf_dir), _contract(spark))
    return out.withColumn("share", F.round("share", 9))


@lake_query
def contract_lines(spark, sf_dir):
    """Lines with a wrong number of fields."""
    return contracts.line_faults(_raw_file(spark, sf_dir))


@lake_query
def contract_check(spark, sf_dir):
    """Declared against actual columns of the raw text."""
    return contracts.check_contract(_raw_credits(spark, sf_dir), _contract(spark))


@lake_query
def contract_typed(spark, sf_dir):
    """The raw text with its declared types; what does not parse is null."""
    out = contracts.apply_contract(_raw_file(spark, sf_dir), _contract(spark))
    return out.groupBy("credit_active").agg(
        F.count(F.lit(1)).alias("rows"), F.count("days_credit").alias("days"), F.min("days_credit").alias("least"),
        F.count("amt_credit_sum").alias("amounts"), F.max("amt_credit_sum").alias("most"), F.count("credit_type").alias("types"),
    )


# --- catalog tables and sinks -----------------------------------------------


@lake_query
def catalog_csv_table(spark, sf_dir):
    """An external text table, created, read through the
    catalog and dropped; invalid text is null."""
    path, database = own_folder(spark, "csv"), f"raw_{uuid.uuid4().hex[:12]}"
    _raw_credits(spark, sf_dir).write.option("header", True).csv(path)
    schema = contracts.schema_from_pairs({f["Name"]: f["Type"] for f in CREDIT_CONTRACT[:4]})
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}-db'")
    storage.create_csv_table(spark, f"{database}.credits", schema, path)
    storage.create_csv_table(spark, f"{database}.dropped", schema, path)
    storage.drop_table(spark, f"{database}.dropped")
    held = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    rows = storage.read_table(spark, "credits", storage.Catalog(path, databases=(database,), path_fallback=False))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count("sk_id_bureau").alias("ids"), F.count("days_credit").alias("days"),
        F.count("amt_credit_sum").alias("amounts"), F.sum("sk_id_bureau").alias("sum_of_ids"), F.lit(",".join(held)).alias("tables"),
    )


@lake_query
def catalog_parquet_table(spark, sf_dir):
    """A partitioned Parquet table by DDL, of which one partition
    is replaced alone."""
    root, database = own_folder(spark, "lake"), f"trusted_{uuid.uuid4().hex[:12]}"
    lake = storage.Catalog(root, databases=(database,), path_fallback=False)
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    storage.write_parquet(lines.withColumn("l_quantity", F.lit(0.0)), lake, "trusted", "lines", "l_returnflag")
    for value in ("A", "N", "R"):
        storage.write_parquet(lines.filter(F.col("l_returnflag") == value), lake, "trusted", "lines", "l_returnflag", overwrite_partitions=True)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}-db'")
    storage.create_parquet_table(spark, f"{database}.lines", lines.schema, lake.path("trusted", "lines"), ["l_returnflag"])
    return storage.read_table(spark, "lines", lake).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_quantity"), 4).alias("quantity"), F.round(F.max("l_extendedprice"), 4).alias("most")
    )


@lake_query
def catalog_fallback(spark, sf_dir):
    """A table the catalog does not know is read from its path, Parquet
    or text, registered, and asked in SQL; an absent one is none."""
    root = own_folder(spark, "zones")
    lake = storage.Catalog(root, databases=(f"no_{uuid.uuid4().hex[:12]}",))
    _table(spark, sf_dir, "nation").write.parquet(lake.path("raw", "nation_kept"))
    _table(spark, sf_dir, "region").write.option("header", True).csv(lake.path("raw", "region_kept"))
    found = storage.load_tables(spark, ["nation_kept", "region_kept", "absent"], lake, required=["nation_kept"])
    count = sum(t is not None for t in found.values())
    joined = spark.sql("SELECT r_name, count(*) AS nations FROM nation_kept JOIN region_kept ON n_regionkey = r_regionkey GROUP BY r_name")
    return joined.withColumn("tables", F.lit(count))


@lake_query
def catalog_schema_inventory(spark, sf_dir):
    """Columns and types of catalog tables."""
    path, database = own_folder(spark, "tables"), f"inventory_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}-db'")
    lake = storage.Catalog(path, databases=(database,), path_fallback=False)
    tables = {}
    for name in ("customer", "orders", "part", "nation"):
        source = _table(spark, sf_dir, name)
        source.write.parquet(f"{path}/{name}")
        storage.create_parquet_table(spark, f"{database}.{name}", source.schema, f"{path}/{name}")
        tables[name] = storage.read_table(spark, name, lake)
    return profiling.schema_inventory(spark, tables)


@lake_query
def output_registry(spark, sf_dir):
    """Outputs written with their rows and columns counted while
    writing; every one is read back and counted again."""
    lake, registry = storage.Catalog(own_folder(spark, "out")), storage.OutputRegistry()
    for name in ("customer", "orders", "supplier"):
        storage.write_parquet(_table(spark, sf_dir, name), lake, "refined", f"{name}_out", registry=registry)
    counts = profiling.table_inventory({n: storage.read_parquet(spark, p) for n, (_, _, p) in registry.entries.items()})
    report = registry.report(spark).join(counts, F.col("dataset") == F.col("table"))
    return report.select("dataset", "row_count", "column_count", (F.col("rows") == F.col("row_count")).alias("confirmed"))


@lake_query
def report_sink(spark, sf_dir):
    """A small report as one text file, read back by its types."""
    lake = storage.Catalog(own_folder(spark, "reports"))
    report = profiling.label_distribution(view(spark, sf_dir, "fx_application"))
    path = storage.write_report(report, lake, "label_distribution")
    return storage.read_csv(spark, path, report.schema)


@lake_query
def file_previews(spark, sf_dir):
    """First rows of files of each format, by path."""
    root = own_folder(spark, "preview")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nation.write.parquet(f"{root}/n.parquet")
    nation.write.json(f"{root}/n.jsonl")
    nation.write.option("header", True).csv(f"{root}/n.csv")
    parts = [
        storage.preview(f"{root}/n.{ext}", 500, spark).select(F.lit(ext).alias("format"), F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")
        for ext in ("parquet", "jsonl", "csv")
    ]
    return profiling.stack_reports(parts)


# --- artifacts --------------------------------------------------------------


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some outputs as a run leaves them, listed."""
    lake = storage.Catalog(own_folder(spark, "run"))
    storage.write_parquet(_table(spark, sf_dir, "events").select("event_id", "event_type"), lake, "refined", "model_predictions_rf", "event_type")
    storage.write_parquet(_table(spark, sf_dir, "nation"), lake, "refined", "train_final_features")
    storage.write_report(_table(spark, sf_dir, "region"), lake, "confusion_matrix")
    return artifacts.list_artifacts(spark, f"{lake.root}/refined")


@lake_query
def artifact_listing(spark, sf_dir):
    """Artifacts with their kind; the one to show first."""
    files = _artifacts(spark, sf_dir)
    first = artifacts.default_artifact(files).select("artifact").first()["artifact"]
    summary = artifacts.artifact_summary(files)
    return summary.select("artifact", "artifact_type", (F.col("files") > 0).alias("has_files"), (F.col("artifact") == first).alias("shown_first"))


@lake_query
def artifact_partitions(spark, sf_dir):
    """V2, V4: rows of an artifact per partition folder, by the files they are in."""
    files = _artifacts(spark, sf_dir)
    rows = artifacts.artifact_rows(spark, files, "model_predictions", "event_type")
    folders = artifacts.partition_summary(artifacts.artifact_files(files, "model_predictions"), "event_type").select("event_type", F.col("files").alias("_files"))
    return rows.join(folders, "event_type").select("artifact", "event_type", "rows", (F.col("files") == F.col("_files")).alias("files_agree"))


@lake_query
def artifact_read(spark, sf_dir):
    """V5, V6: all files of a chosen artifact and kind as one frame."""
    files = artifacts.select_files(_artifacts(spark, sf_dir), ["train_final_features"], ["parquet"], "name")
    return artifacts.read_artifact(spark, files, "train_final").select("n_nationkey", "n_name", "n_regionkey")


@lake_query
def artifact_kinds(spark, sf_dir):
    """Kind of a path, over all customers' made-up paths."""
    words = F.array(*[F.lit(w) for w in ("x/model_predictions_rf/", "x/Confusion/", "x/importance_df/", "refined/train/", "zzz/")])
    paths = _table(spark, sf_dir, "customer").select(F.concat(F.get(words, (F.col("c_custkey") % 5).cast("int")), F.col("c_custkey").cast("string")).alias("key"))
    return paths.groupBy(artifact_type("key").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
