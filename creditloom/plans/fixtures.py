"""The loan-risk tables expressed on the test tables (see FIXTURES.md).

Each view is a projection whose expressions are plain SQL text, so that the
independent check can state the same inputs. ``{dd}`` stands for the day offset
of an order to 2001-12-31.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import flag

SPARK_DAYS = "datediff(o_orderdate, DATE '2001-12-31')"

SOURCES = {
    "fx_application": "customer",
    "fx_bureau": "orders",
    "fx_bureau_balance": "lineitem",
    "fx_previous": "orders",
    "fx_installments": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "fx_monthly": "events",
}

VIEWS: dict[str, dict[str, str]] = {
    "fx_application": {
        "sk_id_curr": "c_custkey",
        "target": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
        "amt_income_total": "2e4 + CAST(c_custkey * 7919 % 180000 AS DOUBLE)",
        "amt_credit": "CASE WHEN c_custkey % 40 = 0 THEN 0e0 ELSE 4e4 + CAST(c_custkey * 104729 % 900000 AS DOUBLE) END",
        "amt_annuity": "CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE 2e3 + CAST(c_custkey * 613 % 50000 AS DOUBLE) END",
        "amt_goods_price": "CASE WHEN c_custkey % 15 = 4 THEN NULL ELSE 3e4 + CAST(c_custkey * 7907 % 800000 AS DOUBLE) END",
        "cnt_children": "CAST(c_custkey % 4 AS INT)",
        "cnt_fam_members": "CASE WHEN c_custkey % 25 = 7 THEN NULL ELSE CAST(c_custkey % 4 + 2 AS DOUBLE) END",
        "days_birth": "CAST(-(7000 + c_custkey * 37 % 18000) AS INT)",
        "days_employed": "CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey * 13 % 9000) END AS INT)",
        "days_registration": "CASE WHEN c_custkey % 30 = 11 THEN 5e0 ELSE CAST(-(c_custkey * 17 % 12000) AS DOUBLE) END",
        "ext_source_1": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE (c_custkey * 31 % 1000) / 1e3 END",
        "ext_source_2": "CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE (c_custkey * 57 % 1000) / 1e3 END",
        "ext_source_3": "CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE (c_custkey * 83 % 1000) / 1e3 END",
        "obs_30_cnt_social_circle": "CASE WHEN c_custkey % 23 = 1 THEN NULL ELSE CAST(c_custkey % 13 AS DOUBLE) END",
        "def_30_cnt_social_circle": "CASE WHEN c_custkey % 23 = 1 THEN NULL ELSE CAST(c_custkey % 3 AS DOUBLE) END",
        "amt_req_credit_bureau_mon": "CASE WHEN c_custkey % 12 = 5 THEN NULL ELSE CAST(c_custkey * 7 % 9 AS DOUBLE) END",
        "amt_req_credit_bureau_year": "CASE WHEN c_custkey % 12 = 5 THEN NULL ELSE CAST(c_custkey * 7 % 11 AS DOUBLE) END",
        "code_gender": "CASE WHEN c_custkey % 50 = 0 THEN 'XNA' WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END",
        "name_contract_type": "CASE WHEN c_custkey % 8 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END",
        "name_education_type": "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN ' ' ELSE c_mktsegment END",
        "organization_type": "CONCAT('NATION_', CAST(c_nationkey AS STRING))",
        "flag_own_car": "CASE WHEN c_custkey % 3 = 1 THEN 'Y' ELSE 'N' END",
        "flag_phone": "CAST(c_custkey % 2 AS INT)",
        "flag_email": "CAST(CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS INT)",
        "reg_city_not_live_city": "CAST(CASE WHEN c_custkey % 14 = 2 THEN 1 ELSE 0 END AS INT)",
        "reg_city_not_work_city": "CAST(CASE WHEN c_custkey % 14 < 4 THEN 1 ELSE 0 END AS INT)",
        "flag_document_2": "0",
        "flag_document_3": "CAST(CASE WHEN c_custkey % 7 < 5 THEN 1 ELSE 0 END AS INT)",
        "mostly_null": "CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS DOUBLE) ELSE NULL END",
    },
    "fx_bureau": {
        "sk_id_bureau": "o_orderkey",
        "sk_id_curr": "o_custkey",
        "credit_active": "CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderkey % 20 = 0 THEN 'Bad debt' ELSE 'Sold' END",
        "credit_type": "CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE o_orderpriority END",
        "days_credit": "CAST({dd} AS INT)",
        "days_credit_enddate": "CASE WHEN o_orderkey % 16 = 5 THEN NULL ELSE CAST({dd} + 365 + o_orderkey % 1500 AS DOUBLE) END",
        "days_enddate_fact": "CASE WHEN o_orderstatus = 'O' AND o_orderkey % 97 <> 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST({dd} + 200 AS DOUBLE) END",
        "amt_credit_sum": "CASE WHEN o_orderkey % 70 = 0 THEN 0e0 ELSE o_totalprice END",
        "amt_credit_sum_debt": "CASE WHEN o_orderkey % 13 = 2 THEN NULL WHEN o_orderkey % 211 = 0 THEN -1e2 WHEN o_orderkey % 70 = 0 THEN 5e1 ELSE o_totalprice * (o_orderkey % 10) / 1e1 END",
        "amt_credit_sum_limit": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice * (o_orderkey % 7) / 1e1 END",
        "amt_credit_sum_overdue": "CASE WHEN o_orderkey % 40 = 0 THEN o_totalprice / 1e2 ELSE 0e0 END",
        "credit_day_overdue": "CAST(CASE WHEN o_orderkey % 40 = 0 THEN o_orderkey % 120 ELSE 0 END AS INT)",
        "days_credit_update": "CAST({dd} + o_orderkey % 400 AS INT)",
        "cnt_credit_prolong": "CAST(CASE WHEN o_orderkey % 90 = 0 THEN 1 ELSE 0 END AS INT)",
    },
    "fx_bureau_balance": {
        "sk_id_bureau": "l_orderkey",
        "months_balance": "CAST(1 - l_linenumber AS INT)",
        "status": "CASE WHEN l_quantity > 47 THEN NULL WHEN l_quantity > 44 THEN 'x' WHEN l_returnflag = 'N' THEN 'C' WHEN l_returnflag = 'A' THEN '0' WHEN l_quantity > 40 THEN '5' WHEN l_quantity > 30 THEN '3' WHEN l_quantity > 15 THEN '2' ELSE '1' END",
    },
    "fx_previous": {
        "sk_id_prev": "o_orderkey",
        "sk_id_curr": "o_custkey",
        "name_contract_status": "CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' THEN 'Refused' WHEN o_orderkey % 4 = 0 THEN 'Unused offer' ELSE 'Canceled' END",
        "name_contract_type": "CASE WHEN o_orderkey % 3 = 0 THEN 'Cash loans' WHEN o_orderkey % 3 = 1 THEN 'Consumer loans' ELSE 'Revolving loans' END",
        "name_client_type": "o_orderpriority",
        "days_decision": "CAST({dd} AS INT)",
        "amt_application": "CASE WHEN o_orderkey % 22 = 0 THEN 0e0 ELSE o_totalprice END",
        "amt_credit": "CASE WHEN o_orderkey % 50 = 0 THEN 0e0 ELSE o_totalprice * (8 + o_orderkey % 5) / 1e1 END",
        "amt_annuity": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 2e1 END",
        "amt_goods_price": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice * 9e0 / 1e1 END",
        "amt_down_payment": "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice / 1e1 END",
        "cnt_payment": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(6 + 6 * (o_orderkey % 8) AS DOUBLE) END",
        "sellerplace_area": "CAST(o_orderkey % 30 - 5 AS INT)",
        "flag_last_appl_per_contract": "CASE WHEN o_orderkey % 100 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 'N' ELSE 'Y' END",
        "nflag_last_appl_in_day": "CAST(CASE WHEN o_orderkey % 45 = 0 THEN 0 ELSE 1 END AS INT)",
    },
    "fx_installments": {
        "sk_id_prev": "l_orderkey",
        "sk_id_curr": "o_custkey",
        "num_instalment_number": "l_linenumber",
        "days_instalment": "CAST(-(l_orderkey % 1000) - 30 * l_linenumber AS DOUBLE)",
        "days_entry_payment": "CASE WHEN l_partkey % 50 = 9 THEN NULL ELSE CAST(-(l_orderkey % 1000) - 30 * l_linenumber - 25 + l_partkey % 61 AS DOUBLE) END",
        "amt_instalment": "CASE WHEN l_partkey % 90 = 0 THEN 0e0 ELSE l_extendedprice END",
        "amt_payment": "CASE WHEN l_partkey % 50 = 9 THEN NULL WHEN l_partkey % 77 = 0 THEN 0e0 ELSE l_extendedprice * (1 - l_discount) * (1 + l_tax) END",
    },
    "fx_monthly": {
        "sk_id_prev": "user_id * 10 + event_id % 3",
        "sk_id_curr": "user_id",
        "event_id": "event_id",
        "months_balance": "CAST(EXTRACT(DAY FROM ts) AS INT) - 31",
        "name_contract_status": "CASE WHEN event_type = 'purchase' THEN 'Completed' WHEN event_type = 'error' THEN NULL ELSE 'Active' END",
        "sk_dpd": "CAST(CASE WHEN event_type = 'error' THEN event_id % 130 ELSE 0 END AS INT)",
        "sk_dpd_def": "CAST(CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN event_id % 130 ELSE 0 END AS INT)",
        "cnt_instalment": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(6 + 6 * (event_id % 6) AS DOUBLE) END",
        "cnt_instalment_future": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 6 AS DOUBLE) END",
        "amt_balance": "value * 1e1",
        "amt_credit_limit_actual": "CAST(CASE WHEN event_id % 20 = 0 THEN 0 ELSE 500 * (1 + event_id % 5) END AS INT)",
        "amt_drawings_current": "CASE WHEN event_type = 'click' THEN NULL ELSE value END",
        "amt_drawings_atm_current": "CASE WHEN event_type = 'view' THEN value WHEN event_type = 'click' THEN NULL ELSE 0e0 END",
        "amt_drawings_pos_current": "CASE WHEN event_type = 'signup' THEN value WHEN event_type = 'click' THEN NULL ELSE 0e0 END",
        "amt_drawings_other_current": "CASE WHEN event_type = 'purchase' THEN value WHEN event_type = 'click' THEN NULL ELSE 0e0 END",
        "cnt_drawings_current": "CAST(event_id % 4 AS INT)",
        "amt_payment_current": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 2e0 END",
        "amt_payment_total_current": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 2e0 + 1e0 END",
        "amt_inst_min_regularity": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE 1e1 END",
    },
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def table(t: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{t}.parquet")

    if name == "fx_installments":
        source = table("lineitem").join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        source = table(SOURCES[name])
    return source.selectExpr(*[f"{e.replace('{dd}', SPARK_DAYS)} AS {c}" for c, e in VIEWS[name].items()])


def rule_predictions(application: DataFrame) -> DataFrame:
    """A rule-based prediction column, to check evaluation on known counts."""
    return application.select(
        "sk_id_curr",
        "target",
        F.col("target").cast("double").alias("label"),
        flag((F.col("sk_id_curr") % 9 == 0) | (F.col("amt_income_total") < 50000.0)).cast("double").alias("prediction"),
    )
