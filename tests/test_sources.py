from __future__ import annotations

import json

import pytest
from conftest import one, values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.sources import artifacts as A
from creditloom.sources import contracts as K
from creditloom.sources import storage as S


@pytest.fixture()
def catalog(tmp_path):
    return S.Catalog(str(tmp_path / "lake"), databases=("absent_db",))


def test_write_registry_and_guard(spark, catalog):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("day"))
    registry = S.OutputRegistry()
    back = S.write_parquet(df, catalog, "trusted", "t", "day", registry)
    assert values(back, "id", "day") == values(df)
    assert values(registry.report(spark)) == [("t", 10, 2, catalog.path("trusted", "t"))]
    with pytest.raises(PermissionError):
        S.write_parquet(df, catalog, "raw", "t")
    with pytest.raises(ValueError):
        catalog.path("gold", "t")


def test_partition_pruning_and_dynamic_overwrite(spark, catalog):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("day"))
    S.write_parquet(df, catalog, "trusted", "p", "day")
    S.write_parquet(spark.sql("SELECT 99L AS id, 1L AS day"), catalog, "trusted", "p", "day", overwrite_partitions=True)
    back = S.read_parquet(spark, catalog.path("trusted", "p"))
    assert values(back.filter("day = 1"), "id") == [(99,)] and back.count() == 6
    plan = back.filter("day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_csv_reads_and_invalid_text(spark, catalog, tmp_path):
    path = tmp_path / "lake" / "raw" / "bureau"
    path.mkdir(parents=True)
    (path / "b.csv").write_text("SK_ID_CURR,AMT\n1,2.5\n2,\nx,NaN\n")
    schema = K.schema_from_pairs({"SK_ID_CURR": "int", "AMT": "double"})
    rows = values(S.read_csv(spark, str(path), schema))
    assert rows[0] == (1, 2.5) and (2, None) in rows and any(r[0] is None for r in rows)
    inferred = S.read_table(spark, "bureau", catalog)  # no database, no Parquet: CSV by path
    assert inferred.columns == ["sk_id_curr", "amt"] and inferred.count() == 3
    S.create_csv_table(spark, "raw_csv_bureau", schema, str(path))
    assert spark.table("raw_csv_bureau").count() == 3
    S.drop_table(spark, "raw_csv_bureau")
    S.drop_table(spark, "raw_csv_bureau")
    assert not spark.catalog.tableExists("raw_csv_bureau")


def test_table_lookup_order(spark, catalog, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS first_db")
    S.write_parquet(spark.range(3).select(F.col("id").alias("SK")), catalog, "refined", "t")
    S.create_parquet_table(spark, "first_db.t", T.StructType([T.StructField("SK", T.LongType())]), catalog.path("refined", "t"))
    found = S.read_table(spark, "t", S.Catalog("nowhere", databases=("absent_db", "first_db")))
    assert found.columns == ["sk"] and found.count() == 3
    with pytest.raises(LookupError):
        S.read_table(spark, "t2", S.Catalog("nowhere", ("first_db",), path_fallback=False))
    loaded = S.load_tables(spark, ["t", "missing"], S.Catalog(str(tmp_path), ("first_db",)), required=["t"])
    assert loaded["missing"] is None and spark.table("t").count() == 3
    spark.sql("DROP DATABASE first_db CASCADE")


def test_partitioned_parquet_table(spark, catalog):
    S.write_parquet(spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("day")), catalog, "trusted", "q", "day")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.IntegerType())])
    S.create_parquet_table(spark, "parted", schema, catalog.path("trusted", "q"), ["day"])
    assert spark.table("parted").filter("day = 1").count() == 2
    S.drop_table(spark, "parted")


def test_reports_previews_and_contract(spark, catalog, tmp_path):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    out = S.write_report(df, catalog, "r")
    assert S.read_csv(spark, out).columns == ["a", "b"]
    (tmp_path / "j.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{"a": 2}\n{"a": 3}\n')
    assert S.preview(str(tmp_path / "j.json"), 5, spark).count() == 2
    assert S.preview(str(tmp_path / "l.jsonl"), 2, spark).count() == 2
    assert S.preview(df, 1).count() == 1
    with pytest.raises(ValueError):
        S.preview(str(tmp_path / "x.xml"), 1, spark)
    (tmp_path / "c.json").write_text(json.dumps([{"Name": "A", "Type": "int"}, {"Name": "C", "Type": "double"}]))
    schema = K.schema_from_json(spark, str(tmp_path / "c.json"))
    assert schema.names == ["a", "c"]
    assert values(K.check_contract(df, schema), "column", "problem") == [("b", "undeclared"), ("c", "missing")]
    assert values(K.check_contract(df, K.schema_from_pairs({"a": "bigint", "b": "string"})), "column", "problem") == [("a", "type")]
    assert K.missing_columns(df, {"a": "int", "z": "int"}) == ["z"]


def test_materialize_keeps_rows(spark):
    df = spark.range(100).select("id", F.rand(1).alias("r"))
    stored = S.materialize(df)
    assert values(stored) == values(stored) and stored.count() == 100


def test_artifact_listing(spark, tmp_path):
    root = tmp_path / "refined"
    for name, text in {
        "train_final_features/day=MON/part-0.parquet": "aaaa",
        "train_final_features/day=TUE/part-1.parquet": "aa",
        "train_final_features/_SUCCESS": "x",
        "model_metrics_rf/part-0.csv": "bbb",
    }.items():
        f = root / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)
    files = A.list_artifacts(spark, str(root)).cache()
    row = one(files.filter("filename = 'part-0.parquet'"))
    assert row.key == "refined/train_final_features/day=MON/part-0.parquet"
    assert (row.level_0, row.artifact, row.subartifact, row.extension) == ("refined", "train_final_features", "day=MON", "parquet")
    assert (row.artifact_type, row.size_bytes, row.partitions) == ("refined_data", 4, {"day": "MON"})
    summary = {r.artifact: r for r in A.artifact_summary(files).collect()}
    assert (summary["train_final_features"].files, summary["train_final_features"].size_text) == (2, "6.00 B")
    assert values(A.artifact_files(files, "TRAIN_final"), "filename") == [("part-0.parquet",), ("part-1.parquet",)]
    assert one(A.default_artifact(files)).filename == "part-0.parquet"
    assert values(A.partition_summary(files, "day"), "day", "files") == [("MON", 1), ("TUE", 1), (None, 1)]
    assert [r.filename for r in A.select_files(files, extensions=["csv"], order="name").collect()] == ["part-0.csv"]
    assert A.read_artifact(spark, files, "nothing") is None
    plan = A.list_artifacts(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_read_artifact_limits_rows(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "refined" / "scores"))
    files = A.list_artifacts(spark, str(tmp_path / "refined"))
    assert A.read_artifact(spark, files, "scores").count() == 10 and A.read_artifact(spark, files, "scores", 4).count() == 4


def test_readable_size(spark):
    df = spark.sql("SELECT * FROM VALUES (0L), (1536L), (5368709120L), (NULL), (9007199254740992L) AS t(b)")
    assert [r[0] for r in df.select(A.readable_size("b")).collect()] == ["0.00 B", "1.50 KB", "5.00 GB", "0.00 B", "8,192.00 TB"]
