"""Registered queries against SQL, and the shape of their plans."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle_compare import connect, difference

import __spark_entry__ as driver
from creditloom.plans.fixtures import view
from creditloom.plans.oracle import ORACLE
from creditloom.operators import profiling
from creditloom.plans import reports

CHECKED = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert difference(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) is None


def test_registry_is_consistent():
    queries, oracle = driver.queries(), driver.oracle_sql()
    assert set(oracle) <= set(queries) and set(CHECKED) <= set(oracle)


def test_the_wide_aggregate_of_previous_hashes(spark, sf_dir):
    text = plan(driver.queries()["entity_block_previous_last"](spark, sf_dir))
    sorted_aggregates = [line for line in text.splitlines() if "SortAggregate" in line]
    assert "HashAggregate" in text and not any("prev_avg_amt_credit" in line or "avg(" in line for line in sorted_aggregates)


def test_entry_is_lazy_and_unique_per_client(spark):
    df = driver.entry(spark)
    assert df.select("sk_id_curr").distinct().count() == df.count() == 150


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "make",
    [
        lambda d: profiling.null_profile(d),
        lambda d: profiling.numeric_summary(d, ["amt_credit", "amt_annuity", "days_birth"]),
        lambda d: reports.correlation_ranking(d, ["amt_credit", "amt_annuity", "days_birth"]),
        lambda d: profiling.category_rate(d, ["code_gender", "flag_own_car"]),
        lambda d: profiling.quick_profile(d),
    ],
)
def test_profiles_scan_once(spark, sf_dir, make):
    assert plan(make(view(spark, sf_dir, "fx_application"))).count("FileScan") == 1


def test_columns_are_pruned_and_filters_pushed(spark, sf_dir):
    text = plan(reports.term_distribution(view(spark, sf_dir, "fx_monthly")))
    assert "ReadSchema: struct<event_id:bigint>" in text and "TakeOrderedAndProject" in text
    joined = plan(driver.queries()["skew_join"](spark, sf_dir))
    assert "CartesianProduct" not in joined and "BroadcastNestedLoopJoin" not in joined


@pytest.mark.parametrize("name", ["client_master", "severity_rate", "stratified_split", "exact_quantiles_global", "coverage_by_label"])
def test_no_nested_loops(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
