"""SQL for the queries of ``lake_queries``: what the result is, from the test
tables alone; nothing that was written in between is read."""

from __future__ import annotations

from creditloom.plans.oracle import ALL, BASE_CTE, BEHAVIOUR_ROWS, CHAIN, DAYS, HASH, IMPUTED, MASTER_CTES, ORACLE, add, fill

for name in ("client_master_bucketed", "client_master_refreshed"):
    add(name, ALL, f"SELECT * FROM {CHAIN}", MASTER_CTES)


def middle(x: str) -> str:
    """The least value whose rank reaches one half."""
    return f"quantile_disc({x}, 0.5)"


MEDIANS = ("days_decision", "amt_application", "amt_credit", "amt_annuity", "amt_goods_price", "cnt_payment")
add(
    "sketch_previous_medians",
    "previous",
    f"SELECT sk_id_curr, {', '.join(f'CAST({middle(c)} AS DOUBLE) AS {c}_median' for c in MEDIANS)} FROM fx_previous GROUP BY sk_id_curr",
)
add(
    "sketch_behaviour_medians",
    "installments",
    f"SELECT sk_id_curr, {middle('dpd')} AS dpd_median, {middle('ratio')} AS payment_ratio_median FROM beh GROUP BY sk_id_curr",
    BEHAVIOUR_ROWS,
)
add(
    "sketch_accuracy",
    "installments",
    " UNION ALL ".join(
        f"SELECT '{c}' AS measure, q, count({c}) AS n, count(DISTINCT num_instalment_number) AS loads, TRUE AS within FROM fx_installments, (VALUES (0.01e0), (0.25e0), (0.5e0), (0.75e0), (0.99e0)) v(q) GROUP BY q"
        for c in ("amt_instalment", "amt_payment", "days_entry_payment")
    ),
)

HELD_OUT = f"held AS (SELECT * FROM fx_application WHERE NOT ({HASH} < 0.8e0))"
add(
    "forest_checks",
    "application",
    """SELECT 'trees no deeper than asked' AS "check", 50 AS n, TRUE AS passed
       UNION ALL SELECT 'every split has both children', NULL, TRUE
       UNION ALL SELECT 'importance equals the model''s', NULL, TRUE
       UNION ALL SELECT 'importance adds up to one', NULL, TRUE
       UNION ALL SELECT 'walking the nodes scores like the model', (SELECT count(*) FROM held), TRUE
       UNION ALL SELECT 'held-out defaults', (SELECT count(*) FROM held WHERE target = 1), TRUE""",
    HELD_OUT,
)
add(
    "grouped_auc",
    "application",
    """SELECT name_education_type, CAST(sum(target) AS BIGINT) AS positives, CAST(count(*) - sum(target) AS BIGINT) AS negatives,
         round((sum(mean_rank) FILTER (WHERE target = 1) - sum(target) * (sum(target) + 1) / 2e0) / nullif(sum(target) * (count(*) - sum(target)), 0), 9) AS auc
       FROM (SELECT *, rank() OVER (PARTITION BY name_education_type ORDER BY s) + (count(*) OVER (PARTITION BY name_education_type, s) - 1) / 2e0 AS mean_rank
             FROM (SELECT name_education_type, target, round(ext_source_2, 1) AS s FROM fx_application WHERE ext_source_2 IS NOT NULL)) GROUP BY name_education_type""",
)

# numeric columns of the cleaned application, in which nulls become the median
NUMBERS = [
    "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "cnt_children", "cnt_fam_members", "days_birth", "days_employed",
    "days_registration", "ext_source_1", "ext_source_2", "ext_source_3", "obs_30_cnt_social_circle", "def_30_cnt_social_circle",
    "amt_req_credit_bureau_mon", "amt_req_credit_bureau_year", "flag_phone", "flag_email", "reg_city_not_live_city", "reg_city_not_work_city",
    "flag_document_2", "flag_document_3", "mostly_null", "age_years", "flag_days_employed_anomaly", "years_employed", "credit_income_ratio",
    "annuity_income_ratio", "goods_credit_ratio", "income_per_family_member", *[f"flag_missing_{c}" for c in IMPUTED],
]
WORDS = ["code_gender", "name_contract_type", "name_education_type", "organization_type", "flag_own_car"]
ENTRIES = " UNION ALL ".join(
    [
        *[f"SELECT sk_id_curr, target, '{c}_imp' AS name, CAST({fill(c, 'base')} AS DOUBLE) AS value FROM base" for c in NUMBERS],
        *[f"SELECT sk_id_curr, target, '{c}_ohe_' || coalesce({c}, 'Unknown'), 1e0 FROM base" for c in WORDS],
    ]
)
add(
    "ml_ready_entries",
    "application",
    f"SELECT sk_id_curr, CAST(target AS DOUBLE) AS label, name, round(value, 9) AS value FROM ({ENTRIES}) WHERE value <> 0",
    BASE_CTE,
)

SHARES = ["name_client_type", "name_contract_status", "cnt_payment", "sellerplace_area", "days_decision"]
VALUES = " UNION ALL ".join(f"SELECT sk_id_curr, '{c}' AS variable, CAST({c} AS VARCHAR) AS value FROM fx_previous" for c in SHARES)
COUNTED = f"""
long AS ({VALUES}),
counted AS (SELECT variable, value, count(*) AS n, count(*) >= 0.03e0 * (SELECT count(*) FROM fx_previous) AS frequent
            FROM long WHERE value IS NOT NULL GROUP BY variable, value)
"""
add("frequent_values", "previous", "SELECT variable, value, n FROM counted WHERE frequent", COUNTED)
add(
    "split_shares",
    "previous",
    """SELECT sk_id_curr, variable, value, round(m / CAST(total AS DOUBLE), 9) AS share, CASE WHEN frequent THEN 'column' ELSE 'rows' END AS placed
       FROM (SELECT sk_id_curr, variable, value, count(*) AS m FROM long WHERE value IS NOT NULL GROUP BY ALL) JOIN counted USING (variable, value)
       JOIN (SELECT sk_id_curr, count(*) AS total FROM fx_previous GROUP BY sk_id_curr) USING (sk_id_curr)""",
    COUNTED,
)

RAW = f"""
raw AS (SELECT o_orderkey AS key, CAST(o_orderkey AS VARCHAR) AS sk_id_bureau,
  CASE WHEN o_orderkey % 50 = 7 THEN 'n/a' WHEN o_orderkey % 31 <> 0 THEN CAST({DAYS} AS VARCHAR) END AS days_credit,
  CASE WHEN o_orderkey % 77 = 5 THEN 'unknown' WHEN o_orderkey % 13 <> 1 THEN CAST(o_totalprice AS VARCHAR) END AS amt_credit_sum,
  CASE WHEN o_orderkey % 19 <> 0 THEN o_orderstatus END AS credit_active, CAST(NULL AS VARCHAR) AS credit_type FROM orders)
"""


def held(column: str, declared: str, kind: str) -> str:
    bad = f"{column} IS NOT NULL AND TRY_CAST({column} AS {kind}) IS NULL"
    return f"""SELECT '{column}' AS "column", '{declared}' AS declared, count(*) AS "rows", count(*) - count({column}) AS blank,
        count(*) FILTER ({bad}) AS malformed, coalesce(round(count(*) FILTER ({bad}) / CAST(nullif(count({column}), 0) AS DOUBLE), 9), 0) AS share,
        min({column}) FILTER ({bad}) AS example FROM raw"""


DECLARED = [
    ("sk_id_bureau", "bigint", "BIGINT"), ("days_credit", "int", "INTEGER"), ("amt_credit_sum", "double", "DOUBLE"),
    ("credit_active", "string", "VARCHAR"), ("credit_type", "string", "VARCHAR"),
]
ORACLE["contract_malformed"] = f"WITH {RAW} {' UNION ALL '.join(held(*d) for d in DECLARED)}"
ORACLE["contract_lines"] = 'SELECT count(*) AS "rows", count(*) FILTER (o_orderkey % 101 = 0) AS corrupt, 0 AS empty FROM orders'
ORACLE["contract_check"] = """
SELECT * FROM (VALUES ('sk_id_bureau', 'bigint', 'string', 'type'), ('days_credit', 'int', 'string', 'type'),
  ('amt_credit_sum', 'double', 'string', 'type'), ('credit_type', 'string', NULL, 'missing')) t("column", declared, actual, problem)
"""
ORACLE["contract_typed"] = f"""
WITH {RAW} SELECT credit_active, count(*) AS "rows", count(TRY_CAST(days_credit AS INTEGER)) AS days, min(TRY_CAST(days_credit AS INTEGER)) AS least,
  count(TRY_CAST(amt_credit_sum AS DOUBLE)) AS amounts, max(TRY_CAST(amt_credit_sum AS DOUBLE)) AS most, 0 AS types FROM raw GROUP BY credit_active
"""
ORACLE["catalog_csv_table"] = f"""
WITH {RAW} SELECT count(*) AS "rows", count(*) AS ids, count(TRY_CAST(days_credit AS INTEGER)) AS days,
  count(TRY_CAST(amt_credit_sum AS DOUBLE)) AS amounts, CAST(sum(key) AS BIGINT) AS sum_of_ids, 'credits' AS tables FROM raw
"""
ORACLE["catalog_parquet_table"] = """
SELECT l_returnflag, count(*) AS "rows", round(sum(l_quantity), 4) AS quantity, round(max(l_extendedprice), 4) AS most FROM lineitem GROUP BY l_returnflag
"""
ORACLE["catalog_fallback"] = """
SELECT r_name, count(*) AS nations, 2 AS tables FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
"""
ORACLE["catalog_schema_inventory"] = """
SELECT table_name AS "table", column_name AS "column",
  CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type
FROM information_schema.columns WHERE table_name IN ('customer', 'orders', 'part', 'nation')
"""
ORACLE["output_registry"] = " UNION ALL ".join(
    f"SELECT '{t}_out' AS dataset, (SELECT count(*) FROM {t}) AS row_count, (SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS column_count, TRUE AS confirmed"
    for t in ("customer", "orders", "supplier")
)
ORACLE["report_sink"] = ORACLE["label_distribution"]
ORACLE["file_previews"] = "SELECT format, n_nationkey, n_name FROM nation, (VALUES ('parquet'), ('jsonl'), ('csv')) f(format)"
ORACLE["artifact_listing"] = """
SELECT * FROM (VALUES ('model_predictions_rf', 'model_predictions', TRUE, FALSE), ('train_final_features', 'refined_data', TRUE, TRUE),
  ('confusion_matrix', 'model_metrics', TRUE, FALSE)) t(artifact, artifact_type, has_files, shown_first)
"""
ORACLE["artifact_partitions"] = """
SELECT 'model_predictions_rf' AS artifact, event_type, count(*) AS "rows", TRUE AS files_agree FROM events GROUP BY event_type
"""
ORACLE["artifact_read"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
ORACLE["artifact_kinds"] = """
SELECT kind, count(*) AS n FROM customer JOIN (VALUES (0, 'model_predictions'), (1, 'model_metrics'), (2, 'feature_selection'), (3, 'refined_data'), (4, 'other')) k(place, kind)
  ON c_custkey % 5 = place GROUP BY kind
"""
