"""Registered queries: SQL where it exists, native plans, pipeline stages."""

from __future__ import annotations

import brute
import pytest
from conftest import SF_DIR
from oracle_compare import connect, difference

import __spark_entry__ as driver
import corpus_pipeline
from creditloom.llm import queries

from creditloom.llm.common import stored


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(driver.queries()[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name]) is None


def test_all_operators_are_registered():
    names = set(driver.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {name.split("_")[0] + "_" for name in names} and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_url_filters", "op4_line_dedup", "op7_source_mixing", "op8_personal_data"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_contract_columns_equal_the_plain_versions(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    plain = brute.repeats(texts)
    rows = queries.op3_suffix_array_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == plain
    near = brute.near(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_near_duplicates(spark, SF_DIR).collect()} == near
    private = {d: brute.sha(brute.joined(brute.private(t))) for d, t in texts.items()}
    assert {r.doc_id: r.base_sha256 for r in queries.op8_personal_data(spark, SF_DIR).collect()} == private
    hidden = {d: brute.sha(brute.joined(brute.secrets(t))) for d, t in texts.items()}
    assert {r.doc_id: r.base_sha256 for r in queries.op5_secret_scan(spark, SF_DIR).collect()} == hidden


def test_decontamination_equals_the_plain_version(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()}
    got = {(r.doc_id, r.item_id): (r.item_tokens, r.n_tiles, r.covered) for r in queries.op10_benchmark_decontamination(spark, SF_DIR).collect()}
    assert got and got == brute.contained(texts, items)


def test_pipeline_stages(spark):
    """Every stage against the plain version of its decision, on what the one before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, SF_DIR))
        after = {r.doc_id: r.text for r in docs.collect()}
        kept.append(len(after))
        assert set(after) <= set(before)
        if name == "quality rules":
            assert not any(brute.quality(t)[-1] for t in after.values())
        elif name == "line dedup":
            plain = brute.line_dedup(before)
            assert after == {d: t for d, t in plain.items() if t == before[d] or t.strip(" ")}
        elif name == "MinHash near-dedup":
            assert set(after) == {d for d, (_, c) in brute.near(before).items() if c == d}
        elif name == "benchmark decontamination":
            items = [r.text.lower() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            assert not any(item in t.lower() for t in after.values() for item in items)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert kept[0] > kept[2] > 0
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
