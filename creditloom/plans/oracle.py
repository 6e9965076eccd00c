"""Independent statements of the registered queries in plain SQL.

Written against the raw test tables with the views of ``fixtures`` as common
table expressions; nothing of the operators is used.
"""

from __future__ import annotations

from creditloom.plans.fixtures import SOURCES, VIEWS

DAYS = "date_diff('day', DATE '2001-12-31', CAST(o_orderdate AS DATE))"

ORACLE: dict[str, str] = {}


def _cte(name: str) -> str:
    cols = ", ".join(f"{e.replace('{dd}', DAYS)} AS {c}" for c, e in VIEWS[name].items())
    return f"{name} AS (SELECT {cols} FROM {SOURCES[name]})"


def add(name: str, views: str, body: str, ctes: str = "") -> None:
    """``views``: blank-separated short names; ``ctes``: further definitions."""
    parts = [_cte(f"fx_{v}") for v in views.split()]
    if ctes:
        parts.append(ctes.strip())
    ORACLE[name] = f"WITH {', '.join(parts)} {body.strip()}"


def avg(x: str, digits: int = 6) -> str:
    return f"round(avg({x}), {digits})"


def raw(x: str) -> str:
    return f"avg({x})"


def share(cond: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def pct(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) * 1e2 / count(*)"


# --- blocks -----------------------------------------------------------------

ACTIVE = "lower(credit_active) = 'active'"
END = "days_credit_enddate"
RECENT = "days_credit BETWEEN -365 AND 0"

BUREAU = f"""
SELECT sk_id_curr,
  count(*) AS bureau_num_records,
  {n(ACTIVE)} AS bureau_active_credits,
  {n("lower(credit_active) = 'closed'")} AS bureau_closed_credits,
  {n("lower(credit_active) IN ('bad debt', 'bad_debt')")} AS bureau_bad_debt_credits,
  round(sum(coalesce(amt_credit_sum, 0)), 6) AS bureau_total_credit_sum,
  {raw("amt_credit_sum")} AS bureau_avg_credit_sum,
  round(sum(coalesce(amt_credit_sum_debt, 0)), 6) AS bureau_total_debt,
  round(sum(coalesce(amt_credit_sum_overdue, 0)), 6) AS bureau_total_overdue,
  max(coalesce(credit_day_overdue, 0)) AS bureau_max_days_overdue,
  {raw("days_credit")} AS bureau_avg_days_credit,
  {n(RECENT)} AS bureau_recent_credits_1y,
  {share(RECENT)} AS bureau_pct_recent_credits_1y,
  {n(END + " IS NULL")} AS bureau_missing_days_credit_enddate,
  {share(END + " IS NULL")} AS bureau_pct_missing_days_credit_enddate,
  {n(END + " < 0")} AS bureau_expected_enddate_past,
  {n(END + " >= 0")} AS bureau_expected_enddate_future,
  max(CASE WHEN {ACTIVE} AND days_enddate_fact IS NOT NULL THEN 1 ELSE 0 END) AS flag_active_with_enddate_fact,
  {share(ACTIVE + " AND days_enddate_fact IS NOT NULL")} AS pct_active_with_enddate_fact,
  {n(ACTIVE + " AND " + END + " < 0")} AS active_expected_enddate_past_count
FROM fx_bureau GROUP BY sk_id_curr
"""
add("entity_block_bureau", "bureau", BUREAU)

BUREAU_SHORT = """
SELECT sk_id_curr,
  count(*) AS bureau_num_records,
  count(*) FILTER (WHERE credit_active = 'Active') AS bureau_active_credits,
  count(*) FILTER (WHERE credit_active = 'Closed') AS bureau_closed_credits,
  count(*) FILTER (WHERE credit_active = 'Bad debt') AS bureau_bad_debt_credits,
  avg(amt_credit_sum) AS bureau_avg_credit_sum,
  round(sum(amt_credit_sum), {d}) AS bureau_total_credit_sum,
  round(sum(amt_credit_sum_debt), {d}) AS bureau_total_debt,
  max(credit_day_overdue) AS bureau_max_days_overdue,
  avg(days_credit) AS bureau_avg_days_credit
FROM fx_bureau GROUP BY sk_id_curr
""".replace("{d}", "6")
add("entity_block_bureau_summary", "bureau", BUREAU_SHORT)


def bureau_profile(digits: int | None) -> str:
    def r(x: str) -> str:
        return x if digits is None else f"round({x}, {digits})"

    return f"""
SELECT p.*, t.target FROM (SELECT sk_id_curr,
  count(*) AS bureau_credit_count,
  {n("lower(credit_active) = 'active'")} AS bureau_active_credit_count,
  {n("lower(credit_active) = 'closed'")} AS bureau_closed_credit_count,
  count(DISTINCT credit_type) AS bureau_credit_type_count,
  {r("sum(coalesce(amt_credit_sum, 0))")} AS bureau_total_credit_sum,
  {r("sum(coalesce(amt_credit_sum_debt, 0))")} AS bureau_total_debt_sum,
  {r("sum(coalesce(amt_credit_sum_overdue, 0))")} AS bureau_total_overdue_sum,
  max(coalesce(credit_day_overdue, 0)) AS bureau_max_credit_day_overdue,
  {r("avg(-days_credit / 365e0)")} AS bureau_avg_credit_age_years,
  {r("max(CASE WHEN amt_credit_sum > 0 THEN amt_credit_sum_debt / amt_credit_sum END)")} AS bureau_debt_ratio_max,
  {r("avg(CASE WHEN amt_credit_sum > 0 THEN amt_credit_sum_debt / amt_credit_sum END)")} AS bureau_debt_ratio_mean,
  CAST(sum(coalesce(cnt_credit_prolong, 0)) AS BIGINT) AS bureau_cnt_credit_prolong_sum,
  {n("coalesce(credit_day_overdue, 0) > 0")} AS bureau_overdue_credit_count,
  min(days_credit_update) AS bureau_oldest_update_days,
  max(days_credit_update) AS bureau_latest_update_days
FROM fx_bureau GROUP BY sk_id_curr) p JOIN fx_application t ON p.sk_id_curr = t.sk_id_curr
"""


add("entity_block_bureau_profile", "bureau application", bureau_profile(6))

BB_ROWS = """
bb AS (SELECT b.sk_id_curr, s.months_balance, upper(coalesce(s.status, 'X')) AS st
       FROM fx_bureau_balance s JOIN fx_bureau b ON s.sk_id_bureau = b.sk_id_bureau)
"""
LATE = "st IN ('1', '2', '3', '4', '5')"
BALANCE = f"""
SELECT sk_id_curr,
  count(*) AS bb_total_snapshots,
  count(DISTINCT months_balance) AS bb_num_months,
  {n("st = 'C'")} AS bb_num_closed,
  {n("st = '0'")} AS bb_num_status_0,
  {n(LATE)} AS bb_num_status_1_5,
  {n("st = 'C'")} AS bb_num_status_c,
  {n("st = 'X'")} AS bb_num_status_x,
  max(CASE WHEN st IN ('0', '1', '2', '3', '4', '5') THEN CAST(st AS INT) END) AS bb_max_status_numeric,
  max(months_balance) AS bb_recent_month,
  min(months_balance) AS bb_oldest_month,
  {share("st = 'C'")} AS bb_pct_closed,
  {share(LATE)} AS bb_pct_dpd
FROM bb GROUP BY sk_id_curr
"""
add("entity_block_balance", "bureau_balance bureau", BALANCE, BB_ROWS)

BALANCE_PROFILE = f"""
SELECT bb.sk_id_curr, t.target,
  count(*) AS bb_total_snapshots,
  count(DISTINCT months_balance) AS bb_months_observed,
  {", ".join(f"count(*) FILTER (WHERE st = '{s}') AS bb_status_{s.lower()}_count" for s in "012345CX")},
  max(CASE WHEN st IN ('0', '1', '2', '3', '4', '5') THEN CAST(st AS INT) END) AS bb_worst_status_numeric,
  {n(LATE)} AS bb_delinquency_months,
  {n("st IN ('3', '4', '5')")} AS bb_severe_delinquency_months,
  {pct(LATE)} AS bb_pct_delinquency_months,
  {pct("st = 'C'")} AS bb_pct_closed_months,
  {pct("st = 'X'")} AS bb_pct_unknown_months
FROM bb JOIN fx_application t ON bb.sk_id_curr = t.sk_id_curr
GROUP BY bb.sk_id_curr, t.target
"""
add("entity_block_balance_profile", "bureau_balance bureau application", BALANCE_PROFILE, BB_ROWS)

add(
    "entity_block_balance_per_credit",
    "bureau_balance",
    f"""
SELECT sk_id_bureau, count(*) AS bb_num_months, {n("status = '0'")} AS bb_status_0, {n("status = '1'")} AS bb_status_1,
  {n("status IN ('2', '3', '4', '5')")} AS bb_late_months, {n("status = 'C'")} AS bb_closed_months,
  {n("status = 'X'")} AS bb_unknown_months
FROM fx_bureau_balance GROUP BY sk_id_bureau
""",
)

PREV_STATUS = "upper(coalesce(name_contract_status, 'UNKNOWN'))"
PREVIOUS_COUNTS = f"""
SELECT sk_id_curr,
  count(*) AS prev_num_applications,
  {n(PREV_STATUS + " = 'APPROVED'")} AS prev_approved_count,
  {n(PREV_STATUS + " = 'REFUSED'")} AS prev_refused_count,
  {n(PREV_STATUS + " = 'CANCELED'")} AS prev_canceled_count,
  {n(PREV_STATUS + " = 'UNUSED OFFER'")} AS prev_unused_offer_count,
  {raw("amt_application")} AS prev_avg_amt_application,
  {raw("amt_credit")} AS prev_avg_amt_credit,
  {raw("amt_annuity")} AS prev_avg_amt_annuity,
  round(sum(coalesce(amt_credit, 0)), 6) AS prev_total_amt_credit,
  {raw("days_decision")} AS prev_avg_days_decision,
  min(days_decision) AS prev_min_days_decision,
  {raw("CASE WHEN amt_application > 0 THEN amt_credit / amt_application END")} AS prev_credit_application_ratio,
  {raw("cnt_payment")} AS prev_avg_cnt_payment
FROM fx_previous GROUP BY sk_id_curr
"""
PREV_LAST = f"""
SELECT sk_id_curr, {PREV_STATUS} AS prev_last_status FROM (
  SELECT *, row_number() OVER (PARTITION BY sk_id_curr ORDER BY days_decision DESC NULLS LAST, sk_id_prev DESC) AS rn FROM fx_previous)
WHERE rn = 1
"""
PREVIOUS = f"SELECT * FROM ({PREVIOUS_COUNTS}) JOIN ({PREV_LAST}) USING (sk_id_curr)"
add("entity_block_previous_last", "previous", PREVIOUS)

PREVIOUS_SHORT = """
SELECT sk_id_curr, count(*) AS prev_num_applications,
  count(*) FILTER (WHERE name_contract_status = 'Approved') AS prev_approved,
  count(*) FILTER (WHERE name_contract_status = 'Refused') AS prev_refused,
  avg(amt_application) AS prev_avg_amt_application,
  avg(amt_credit) AS prev_avg_amt_credit,
  avg(amt_down_payment) AS prev_avg_down_payment
FROM fx_previous GROUP BY sk_id_curr
"""
add("entity_block_previous_summary", "previous", PREVIOUS_SHORT)


def med(x: str) -> str:
    return f"quantile_disc({x}, 0.5)"


PREVIOUS_NUMERIC = f"""
SELECT sk_id_curr,
  count(sk_id_prev) AS previous_count,
  max(days_decision) AS days_decision_max,
  {med("days_decision")} AS days_decision_median,
  {med("amt_application")} AS amt_application_median,
  {med("amt_credit")} AS amt_credit_median,
  {med("amt_annuity")} AS amt_annuity_median,
  {med("amt_goods_price")} AS amt_goods_price_median,
  round(sum(amt_credit), 6) AS amt_credit_sum,
  {med("cnt_payment")} AS cnt_payment_median,
  {med("CASE WHEN amt_credit > 0 THEN amt_application / amt_credit END")} AS application_credit_ratio_median,
  {med("CASE WHEN amt_credit > 0 THEN amt_annuity / amt_credit END")} AS annuity_credit_ratio_median,
  {med("CASE WHEN amt_credit > 0 THEN amt_goods_price / amt_credit END")} AS goods_credit_ratio_median,
  {share("amt_annuity IS NULL")} AS amt_annuity_missing_mean,
  {share("amt_goods_price IS NULL")} AS amt_goods_price_missing_mean,
  {share("cnt_payment IS NULL")} AS cnt_payment_missing_mean,
  avg(CASE flag_last_appl_per_contract WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END) AS last_appl_per_contract_mean,
  avg(nflag_last_appl_in_day) AS last_appl_in_day_mean,
  {share("coalesce(sellerplace_area, 0) <= 0")} AS sellerplace_area_nonpositive_mean,
  {med("CASE WHEN sellerplace_area > 0 THEN sellerplace_area END")} AS sellerplace_area_positive_median
FROM fx_previous GROUP BY sk_id_curr
"""
add("entity_block_previous_numeric", "previous", PREVIOUS_NUMERIC)

INST_RATIO = "CASE WHEN amt_instalment > 0 THEN amt_payment / amt_instalment END"
DELAY = "(days_entry_payment - days_instalment)"
INSTALLMENTS = f"""
SELECT sk_id_curr,
  count(*) AS inst_num_payments,
  {raw(DELAY)} AS inst_avg_payment_delay,
  max({DELAY}) AS inst_max_payment_delay,
  {n(DELAY + " > 0")} AS inst_late_payment_count,
  {share(DELAY + " > 0")} AS inst_pct_late_payments,
  {raw(INST_RATIO)} AS inst_avg_payment_ratio,
  min({INST_RATIO}) AS inst_min_payment_ratio,
  {n(f"({INST_RATIO}) < 1")} AS inst_underpayment_count,
  {share(f"({INST_RATIO}) < 1")} AS inst_pct_underpayment,
  round(sum(coalesce(amt_instalment, 0)), 6) AS inst_total_instalment,
  round(sum(coalesce(amt_payment, 0)), 6) AS inst_total_payment
FROM fx_installments GROUP BY sk_id_curr
"""
add("entity_block_installments", "installments", INSTALLMENTS)

INSTALLMENTS_SHORT = f"""
SELECT sk_id_curr, count(*) AS inst_num_payments,
  avg(amt_instalment) AS inst_avg_instalment,
  avg(amt_payment) AS inst_avg_payment,
  avg(amt_payment - amt_instalment) AS inst_avg_payment_diff,
  {n(DELAY + " > 0")} AS inst_late_payments,
  avg({DELAY}) AS inst_avg_days_delay
FROM fx_installments GROUP BY sk_id_curr
"""
add("entity_block_installments_summary", "installments", INSTALLMENTS_SHORT)

BEHAVIOUR_ROWS = f"""
beh AS (SELECT *, greatest({DELAY}, 0) AS dpd,
          CASE WHEN amt_instalment IS NULL OR amt_instalment = 0 THEN NULL ELSE least(amt_payment / amt_instalment, 3) END AS ratio
        FROM fx_installments)
"""
BEHAVIOUR = f"""
SELECT sk_id_curr,
  count(num_instalment_number) AS installments_count,
  count(DISTINCT sk_id_prev) AS previous_loans_nunique,
  {med("dpd")} AS dpd_median,
  max(dpd) AS dpd_max,
  {share("dpd > 0")} AS late_payment_mean,
  {n("dpd > 30")} AS late_30_sum,
  round(sum(amt_instalment), 6) AS amt_instalment_sum,
  round(sum(amt_payment), 6) AS amt_payment_sum,
  {med("ratio")} AS payment_ratio_median,
  {share("amt_payment < amt_instalment")} AS underpaid_mean,
  {share("coalesce(amt_payment, 0) = 0")} AS missed_payment_mean
FROM beh GROUP BY sk_id_curr
"""
add("entity_block_behaviour", "installments", BEHAVIOUR, BEHAVIOUR_ROWS)
add(
    "entity_block_behaviour_null_safe",
    "installments",
    f"""
SELECT sk_id_curr, {med("dpd")} AS dpd_median, max(dpd) AS dpd_max, {med("ratio")} AS payment_ratio_median
FROM (SELECT sk_id_curr, CASE WHEN {DELAY} IS NOT NULL THEN greatest({DELAY}, 0) END AS dpd,
        CASE WHEN amt_instalment <> 0 AND amt_payment IS NOT NULL THEN least(amt_payment / amt_instalment, 3) END AS ratio
      FROM fx_installments) GROUP BY sk_id_curr
""",
)

POS = f"""
SELECT sk_id_curr,
  count(*) AS pos_num_records,
  {raw("months_balance")} AS pos_avg_months_balance,
  max(sk_dpd) AS pos_max_sk_dpd,
  {raw("sk_dpd")} AS pos_avg_sk_dpd,
  max(sk_dpd_def) AS pos_max_sk_dpd_def,
  {raw("sk_dpd_def")} AS pos_avg_sk_dpd_def,
  {n("upper(name_contract_status) = 'COMPLETED'")} AS pos_completed_count,
  {n("upper(name_contract_status) = 'ACTIVE'")} AS pos_active_count,
  {share("upper(name_contract_status) = 'COMPLETED'")} AS pos_pct_completed,
  {raw("cnt_instalment")} AS pos_avg_cnt_instalment,
  {raw("cnt_instalment_future")} AS pos_avg_cnt_instalment_future
FROM fx_monthly GROUP BY sk_id_curr
"""
add("entity_block_pos", "monthly", POS)

POS_SHORT = """
SELECT sk_id_curr, count(*) AS pos_num_records, max(sk_dpd) AS pos_max_dpd, avg(sk_dpd) AS pos_avg_dpd,
  max(sk_dpd_def) AS pos_max_dpd_def, avg(cnt_instalment_future) AS pos_avg_installments_future
FROM fx_monthly GROUP BY sk_id_curr
"""
add("entity_block_pos_summary", "monthly", POS_SHORT)

POS_PROFILE_ROWS = """
usual AS (SELECT sk_id_curr, name_contract_status AS frequent_status
          FROM (SELECT sk_id_curr, name_contract_status,
                  row_number() OVER (PARTITION BY sk_id_curr ORDER BY count(*) DESC, name_contract_status) AS rn
                FROM fx_monthly WHERE name_contract_status IS NOT NULL GROUP BY sk_id_curr, name_contract_status)
          WHERE rn = 1),
posp AS (SELECT m.sk_id_curr, t.target, count(*) AS total_snapshots, count(DISTINCT sk_id_prev) AS pos_credits,
           count(*) FILTER (WHERE sk_dpd > 0) AS months_in_arrears, max(sk_dpd) AS max_dpd, avg(sk_dpd) AS avg_dpd,
           max(cnt_instalment) AS max_term
         FROM fx_monthly m JOIN fx_application t ON m.sk_id_curr = t.sk_id_curr GROUP BY m.sk_id_curr, t.target)
"""
add(
    "entity_block_pos_profile",
    "monthly application",
    """SELECT posp.*, usual.frequent_status
       FROM posp LEFT JOIN usual ON posp.sk_id_curr = usual.sk_id_curr""",
    POS_PROFILE_ROWS,
)

UTIL = "CASE WHEN amt_credit_limit_actual > 0 THEN amt_balance / amt_credit_limit_actual END"
CARD = f"""
SELECT sk_id_curr,
  count(*) AS cc_num_records,
  {raw("amt_balance")} AS cc_avg_balance,
  max(amt_balance) AS cc_max_balance,
  {raw("amt_credit_limit_actual")} AS cc_avg_credit_limit,
  max(amt_credit_limit_actual) AS cc_max_credit_limit,
  {raw("amt_drawings_current")} AS cc_avg_drawings,
  round(sum(coalesce(amt_drawings_current, 0)), 6) AS cc_total_drawings,
  {raw("amt_payment_total_current")} AS cc_avg_payment_total,
  round(sum(coalesce(amt_payment_total_current, 0)), 6) AS cc_total_payment,
  max(sk_dpd) AS cc_max_dpd,
  {raw("sk_dpd")} AS cc_avg_dpd,
  max(sk_dpd_def) AS cc_max_dpd_def,
  {raw("sk_dpd_def")} AS cc_avg_dpd_def,
  {raw("cnt_drawings_current")} AS cc_avg_cnt_drawings,
  {raw(UTIL)} AS cc_utilization_ratio,
  {n("amt_credit_limit_actual IS NULL OR amt_credit_limit_actual <= 0")} AS cc_missing_limit_count
FROM fx_monthly GROUP BY sk_id_curr
"""
add("entity_block_card", "monthly", CARD)

CARD_SHORT = """
SELECT sk_id_curr, count(*) AS cc_num_records, avg(amt_balance) AS cc_avg_balance,
  max(amt_balance) AS cc_max_balance, avg(amt_credit_limit_actual) AS cc_avg_limit,
  max(sk_dpd) AS cc_max_dpd, max(sk_dpd_def) AS cc_max_dpd_def
FROM fx_monthly GROUP BY sk_id_curr
"""
add("entity_block_card_summary", "monthly", CARD_SHORT)

CARD_PROFILE_ROWS = f"""
ccp AS (SELECT p.*, t.target FROM (SELECT sk_id_curr, count(*) AS total_snapshots, count(DISTINCT sk_id_prev) AS cards,
          avg(amt_balance) AS avg_balance, max(amt_balance) AS max_balance, avg(({UTIL}) * 1e2) AS utilisation_pct,
          count(*) FILTER (WHERE sk_dpd > 0) AS months_in_arrears, max(sk_dpd) AS max_dpd,
          {pct("amt_payment_current < amt_inst_min_regularity")} AS pct_below_minimum
        FROM fx_monthly GROUP BY sk_id_curr) p JOIN fx_application t ON p.sk_id_curr = t.sk_id_curr)
"""
add(
    "entity_block_card_profile",
    "monthly application",
    """SELECT * REPLACE (round(avg_balance, 8) AS avg_balance, round(max_balance, 8) AS max_balance,
         round(utilisation_pct, 6) AS utilisation_pct, round(pct_below_minimum, 6) AS pct_below_minimum) FROM ccp""",
    CARD_PROFILE_ROWS,
)

STATUSES = ["Approved", "Canceled", "Refused", "Unused offer"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def slug(text: str) -> str:
    return text.lower().replace(" ", "_").replace("-", "_")


def value_shares(column: str, values: list[str]) -> str:
    return ", ".join(f"avg(CASE WHEN {column} = '{v}' THEN 1e0 ELSE 0e0 END) AS {column}_{slug(v)}" for v in values)


add(
    "category_shares",
    "previous",
    f"""SELECT sk_id_curr, {value_shares("name_contract_status", STATUSES)}, {value_shares("name_client_type", PRIORITIES)}
        FROM fx_previous GROUP BY sk_id_curr""",
)

add(
    "metric_kinds",
    "previous",
    f"""
SELECT * FROM (SELECT sk_id_curr, count(*) AS n, count(amt_annuity) AS n_amount, {n("amt_application > 2e5")} AS n_large,
  round(sum(amt_application), 4) AS total,
  round(sum(amt_application) FILTER (WHERE name_contract_status = 'Approved'), 4) AS total_approved,
  round(sum(coalesce(amt_annuity, 0)), 4) AS total_null_safe,
  avg(days_decision) AS average,
  avg(days_decision) FILTER (WHERE name_contract_status = 'Refused') AS average_refused,
  min(amt_application) AS lowest, max(amt_application) AS highest,
  max(amt_application) FILTER (WHERE name_contract_status = 'Canceled') AS highest_canceled,
  count(DISTINCT name_contract_status) AS statuses,
  {share("amt_application > 2e5")} AS share_large, {pct("amt_application > 2e5")} AS pct_large,
  max(CASE WHEN name_contract_status = 'Unused offer' THEN 1 ELSE 0 END) AS has_unused,
  arg_min(name_contract_status, sk_id_prev) AS first_status,
  quantile_disc(days_decision, 0.5) AS median_decision
FROM fx_previous GROUP BY sk_id_curr) JOIN (
  SELECT sk_id_curr, name_client_type AS usual_client_type FROM (
    SELECT sk_id_curr, name_client_type, row_number() OVER (PARTITION BY sk_id_curr ORDER BY count(*) DESC, name_client_type) AS rn
    FROM fx_previous GROUP BY sk_id_curr, name_client_type) WHERE rn = 1) USING (sk_id_curr)
""",
)

# --- masters ----------------------------------------------------------------

IMPUTED = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "cnt_fam_members"]


def fill(c: str, source: str = "fx_application", q: str = "quantile_disc") -> str:
    return f"coalesce({c}, (SELECT {q}({c}, 0.5) FROM {source}))"


BASE_CTE = f"""
base AS (SELECT * REPLACE (
    {", ".join(f"{fill(c)} AS {c}" for c in IMPUTED)},
    CASE WHEN upper(code_gender) = 'XNA' THEN 'Unknown' ELSE coalesce(code_gender, 'Unknown') END AS code_gender,
    coalesce(name_education_type, 'Unknown') AS name_education_type),
  abs(days_birth) / 365e0 AS age_years,
  CASE WHEN days_employed = 365243 THEN 1 ELSE 0 END AS flag_days_employed_anomaly,
  CASE WHEN days_employed <> 365243 THEN abs(days_employed) / 365e0 END AS years_employed,
  CASE WHEN amt_income_total > 0 THEN amt_credit / amt_income_total END AS credit_income_ratio,
  CASE WHEN amt_income_total > 0 THEN amt_annuity / amt_income_total END AS annuity_income_ratio,
  CASE WHEN amt_credit > 0 THEN amt_goods_price / amt_credit END AS goods_credit_ratio,
  CASE WHEN cnt_fam_members > 0 THEN amt_income_total / cnt_fam_members END AS income_per_family_member,
  {", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS flag_missing_{c}" for c in IMPUTED)}
  FROM fx_application WHERE target IN (0, 1))
"""
add("application_base", "application", "SELECT * FROM base", BASE_CTE)

ALL = "application bureau bureau_balance previous installments monthly"
MASTER_CTES = ",".join(
    [
        BASE_CTE, BB_ROWS, f"bu AS ({BUREAU})", f"bal AS ({BALANCE})", f"pr AS ({PREVIOUS})", f"ins AS ({INSTALLMENTS})",
        f"po AS ({POS})", f"ca AS ({CARD})",
    ]
)
CHAIN = """base LEFT JOIN bu USING (sk_id_curr) LEFT JOIN bal USING (sk_id_curr) LEFT JOIN pr USING (sk_id_curr)
  LEFT JOIN ins USING (sk_id_curr) LEFT JOIN po USING (sk_id_curr) LEFT JOIN ca USING (sk_id_curr)"""
add("client_master", ALL, f"SELECT * FROM {CHAIN}", MASTER_CTES)

CHECKS = [
    ("rows", "rows_master", "count(*)"),
    ("rows", "rows_master_eq_base", "CASE WHEN count(*) = (SELECT count(*) FROM fx_application) THEN 1 ELSE 0 END"),
    ("keys", "distinct_keys", "count(DISTINCT sk_id_curr)"),
    ("keys", "duplicated_keys", "count(*) - count(DISTINCT sk_id_curr)"),
    *[
        ("nulls", f"nulls_{c}", f"count(*) - count({c})")
        for c in ("target", "age_years", "credit_income_ratio", "bureau_num_records", "pos_num_records")
    ],
    ("schema", "categorical_columns", "6"),
    ("schema", "numeric_columns", "117"),
]
add(
    "master_validation",
    ALL,
    " UNION ALL ".join(
        f"SELECT '{g}' AS check_group, '{c}' AS check_name, CAST(any_value({e}) AS DOUBLE) AS check_value FROM master"
        if e.isdigit()
        else f"SELECT '{g}' AS check_group, '{c}' AS check_name, CAST({e} AS DOUBLE) AS check_value FROM master"
        for g, c, e in CHECKS
    ),
    MASTER_CTES + f", master AS (SELECT * FROM {CHAIN})",
)

ANALYTIC_CTES = f"""
base1 AS (SELECT *, abs(days_birth) / 365e0 AS age_years,
    CASE WHEN days_employed = 365243 THEN 1 ELSE 0 END AS days_employed_anomaly,
    CASE WHEN days_employed <> 365243 THEN abs(days_employed) / 365e0 END AS years_employed_clean,
    amt_credit / nullif(amt_income_total, 0) AS credit_income_ratio,
    amt_annuity / nullif(amt_income_total, 0) AS annuity_income_ratio,
    amt_goods_price / nullif(amt_credit, 0) AS goods_credit_ratio,
    CASE WHEN code_gender = 'XNA' THEN 'Unknown' ELSE code_gender END AS code_gender_clean
  FROM fx_application WHERE target IN (0, 1)),
bu AS ({BUREAU_SHORT}), pr AS ({PREVIOUS_SHORT}), po AS ({POS_SHORT}), ca AS ({CARD_SHORT}), ins AS ({INSTALLMENTS_SHORT}),
master1 AS (SELECT * FROM base1 LEFT JOIN bu USING (sk_id_curr) LEFT JOIN pr USING (sk_id_curr)
  LEFT JOIN po USING (sk_id_curr) LEFT JOIN ca USING (sk_id_curr) LEFT JOIN ins USING (sk_id_curr))
"""
add("analytic_master", ALL, "SELECT * FROM master1", ANALYTIC_CTES)
add(
    "label_summary",
    ALL,
    f"""SELECT target, count(*) AS clients, {", ".join(f"{avg(c)} AS avg_{c}" for c in (
        "age_years", "credit_income_ratio", "annuity_income_ratio", "bureau_num_records", "prev_num_applications", "inst_late_payments"))}
        FROM master1 GROUP BY target""",
    ANALYTIC_CTES,
)
add(
    "master_missing_source",
    "application monthly",
    """SELECT sk_id_curr, abs(days_birth) / 365e0 AS age_years, pos_num_records, CAST(NULL AS BIGINT) AS bureau_num_records,
         CAST(NULL AS VARCHAR) AS prev_last_status, CAST(NULL AS DOUBLE) AS inst_avg_payment_ratio,
         CAST(NULL AS DOUBLE) AS cc_avg_balance, CAST(NULL AS BIGINT) AS bb_total_snapshots
       FROM fx_application LEFT JOIN (SELECT sk_id_curr, count(*) AS pos_num_records FROM fx_monthly GROUP BY 1) USING (sk_id_curr)""",
)

# --- quantiles --------------------------------------------------------------

AMOUNTS = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"]
BUREAU_AMOUNTS = ["amt_credit_sum", "amt_credit_sum_debt", "amt_credit_sum_limit", "amt_credit_sum_overdue"]
add(
    "exact_quantiles_global",
    "bureau",
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({q} AS DOUBLE) AS q, quantile_disc({c}, {q}) AS value FROM fx_bureau"
        for c in BUREAU_AMOUNTS
        for q in (0.25, 0.5, 0.9, 0.99)
    ),
)
add(
    "exact_quantiles_grouped",
    "installments",
    " UNION ALL ".join(
        f"""SELECT num_instalment_number, 'amt_payment' AS variable, CAST({q} AS DOUBLE) AS q,
            round(quantile_cont(amt_payment, {q}), 4) AS value FROM fx_installments GROUP BY num_instalment_number"""
        for q in (0.1, 0.5)
    ),
)
add(
    "exact_client_medians",
    "installments",
    f"SELECT sk_id_curr, median({DELAY}) AS delay_median FROM fx_installments GROUP BY sk_id_curr",
)

# --- profiling --------------------------------------------------------------

APPLICATION = list(VIEWS["fx_application"])
TEXT = [
    "code_gender", "name_contract_type", "name_education_type", "organization_type", "flag_own_car",
]
NULL_ROWS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count(*) AS total,
        (count(*) - count({c})) * 1e2 / count(*) AS pct_nulls FROM fx_application"""
    for c in APPLICATION
)
add("null_profile", "application", NULL_ROWS)
add("findings_nulls", "application", f'SELECT * FROM ({NULL_ROWS}) ORDER BY pct_nulls DESC, nulls DESC, "column" LIMIT 10')


def summary(table: str, cols: list[str], quantiles: dict[str, float]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count({c}) AS n, count(*) - count({c}) AS nulls, CAST(min({c}) AS DOUBLE) AS min,
            round(avg({c}), 6) AS mean, CAST(max({c}) AS DOUBLE) AS max,
            {", ".join(f"CAST(quantile_disc({c}, {q}) AS DOUBLE) AS {name}" for name, q in quantiles.items())} FROM {table}"""
        for c in cols
    )


add("numeric_summary", "application", summary("fx_application", [*AMOUNTS, "days_birth", "days_employed"], {"p25": 0.25, "median": 0.5, "p75": 0.75}))
add("amount_summary", "bureau", summary("fx_bureau", BUREAU_AMOUNTS, {"median": 0.5, "p90": 0.9}))
add(
    "iqr_outliers",
    "application",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, q1, q3, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lower_bound, q3 + 1.5e0 * (q3 - q1) AS upper_bound,
            count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) AS outliers, count({c}) AS total,
            count(*) FILTER (WHERE {c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1)) * 1e2 / count({c}) AS pct_outliers
            FROM fx_application, (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM fx_application)
            GROUP BY q1, q3"""
        for c in AMOUNTS
    ),
)
add(
    "histogram",
    "application",
    """SELECT CAST(bin AS INT) AS bin, round(lo + (bin - 1) * w, 6) AS lower, round(lo + bin * w, 6) AS upper, coalesce(n, 0) AS n
       FROM range(1, 51) AS r(bin) CROSS JOIN edges LEFT JOIN (
         SELECT least(CAST(floor((amt_income_total - lo) / w) AS INT) + 1, 50) AS bin, count(*) AS n
         FROM fx_application, edges GROUP BY 1) USING (bin)""",
    "edges AS (SELECT min(amt_income_total) AS lo, (max(amt_income_total) - min(amt_income_total)) / 50e0 AS w FROM fx_application)",
)
ROLES = {
    "target": "target", "amt_income_total": "income", "amt_credit": "credit", "amt_annuity": "annuity",
    "ext_source_1": "external score", "ext_source_2": "external score", "ext_source_3": "external score",
    "amt_req_credit_bureau_mon": "bureau", "amt_req_credit_bureau_year": "bureau",
    "obs_30_cnt_social_circle": "social circle", "def_30_cnt_social_circle": "social circle",
    "days_birth": "time", "days_employed": "time", "days_registration": "time",
    "reg_city_not_live_city": "geography", "reg_city_not_work_city": "geography",
    "flag_document_2": "documents", "flag_document_3": "documents",
    "name_contract_type": "categorical", "name_education_type": "categorical",
}
add(
    "quick_profile",
    "application",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values,
            (count(*) - count({c})) * 1e2 / count(*) AS pct_nulls, '{ROLES.get(c, "other")}' AS role FROM fx_application"""
        for c in APPLICATION
    ),
)
add("top_missing", "application", f'SELECT "column", nulls FROM ({NULL_ROWS}) WHERE pct_nulls > 0 ORDER BY pct_nulls DESC, "column" LIMIT 5')
RULES = {
    "active with factual end": "lower(credit_active) = 'active' AND days_enddate_fact IS NOT NULL",
    "closed or sold without factual end": "lower(credit_active) IN ('closed', 'sold') AND days_enddate_fact IS NULL",
    "negative debt": "amt_credit_sum_debt < 0",
    "negative overdue": "amt_credit_sum_overdue < 0",
    "zero credit with debt": "coalesce(amt_credit_sum, 0) = 0 AND coalesce(amt_credit_sum_debt, 0) > 0",
    "positive days_credit": "days_credit > 0",
    "positive days_credit_update": "days_credit_update > 0",
}
add(
    "rule_violations",
    "bureau",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{r}' AS rule, count(*) AS rows_affected, count(DISTINCT sk_id_curr) AS entities_affected,
            count(*) * 1e2 / (SELECT count(*) FROM fx_bureau) AS pct_of_rows FROM fx_bureau WHERE {c}"""
        for r, c in RULES.items()
    )
    + ") WHERE rows_affected > 0",
)
VIEW_ORDER = ["application", "bureau", "bureau_balance", "previous", "installments", "monthly"]
add(
    "table_inventory",
    ALL,
    " UNION ALL ".join(f'SELECT \'fx_{v}\' AS "table", count(*) AS rows FROM fx_{v}' for v in VIEW_ORDER),
)
NOT_NUMERIC = {
    "application": TEXT, "bureau": ["credit_active", "credit_type"], "bureau_balance": ["status"],
    "previous": ["name_contract_status", "name_contract_type", "name_client_type", "flag_last_appl_per_contract"],
    "installments": [], "monthly": ["name_contract_status"],
}
add(
    "quality_resume",
    ALL,
    " UNION ALL ".join(
        f"""SELECT 'fx_{v}' AS "table", count(*) AS rows, {len(VIEWS[f"fx_{v}"])} AS columns,
            {" + ".join(f"(count(*) - count({c}))" for c in VIEWS[f"fx_{v}"] if c not in NOT_NUMERIC[v])} AS numeric_nulls FROM fx_{v}"""
        for v in VIEW_ORDER
    ),
)


def distribution(table: str, key: str, name: str, extra: str = "") -> str:
    return f"""SELECT {key} AS {name}, count(*) AS n, count(*) * 1e2 / (SELECT count(*) FROM {table}) AS pct{extra}
               FROM {table} GROUP BY {key}"""


add("label_distribution", "application", distribution("fx_application", "target", "target"))
CATS = ["code_gender", "name_contract_type", "name_education_type", "organization_type", "flag_own_car"]
add(
    "category_rate",
    "application",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, {c} AS value, count(*) AS total, {n("target = 1")} AS defaults, {pct("target = 1")} AS default_rate_pct
            FROM fx_application WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in CATS
    ),
)
EXT_N = "(CASE WHEN ext_source_1 IS NULL THEN 0 ELSE 1 END + CASE WHEN ext_source_2 IS NULL THEN 0 ELSE 1 END + CASE WHEN ext_source_3 IS NULL THEN 0 ELSE 1 END)"
EXT_SUM = "(coalesce(ext_source_1, 0) + coalesce(ext_source_2, 0) + coalesce(ext_source_3, 0))"
EXT_SQ = "(coalesce(ext_source_1 * ext_source_1, 0) + coalesce(ext_source_2 * ext_source_2, 0) + coalesce(ext_source_3 * ext_source_3, 0))"
EXT_MEAN = f"CASE WHEN {EXT_N} > 0 THEN {EXT_SUM} / {EXT_N} END"
EXT_STD = f"CASE WHEN {EXT_N} > 1 THEN sqrt(greatest(({EXT_SQ} - {EXT_SUM} * {EXT_SUM} / {EXT_N}) / ({EXT_N} - 1), 0)) END"
EXT_MIN, EXT_MAX = (f"{f}(ext_source_1, ext_source_2, ext_source_3)" for f in ("least", "greatest"))
add(
    "business_kpis",
    "application",
    f"""SELECT count(*) AS rows, avg(target) * 1e2 AS positive_rate_pct, round(avg(amt_income_total), 6) AS mean_amount,
        'amt_income_total' AS amount_column, round(avg({EXT_MEAN}), 6) AS mean_external_score FROM fx_application""",
)
add(
    "distribution_summary",
    "application",
    " UNION ALL ".join(
        f"""SELECT target, '{c}' AS variable, count({c}) AS n, min({c}) AS min, quantile_disc({c}, 0.25) AS p25,
            quantile_disc({c}, 0.5) AS median, quantile_disc({c}, 0.75) AS p75, max({c}) AS max, round(avg({c}), 6) AS mean
            FROM fx_application GROUP BY target"""
        for c in AMOUNTS
    ),
)
add(
    "duplicate_keys",
    "previous",
    "SELECT sk_id_curr, days_decision, count(*) AS rows FROM fx_previous GROUP BY 1, 2 HAVING count(*) > 1",
)
CORR = [
    *AMOUNTS, "days_birth", "days_employed", "days_registration", "cnt_children", "cnt_fam_members", "ext_source_1",
    "ext_source_2", "ext_source_3",
]
CORR_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(corr(CAST(target AS DOUBLE), CAST({c} AS DOUBLE)), 6) AS corr_target FROM fx_application"
    for c in CORR
)
add("corr_ranking", "application", f"SELECT *, abs(corr_target) AS abs_corr FROM ({CORR_ROWS})")
add(
    "findings_correlation",
    "application",
    f"SELECT *, abs(corr_target) AS abs_corr FROM ({CORR_ROWS}) ORDER BY abs(corr_target) DESC, variable LIMIT 10",
)
add(
    "score_summary",
    "application",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count({c}) AS n, quantile_disc({c}, 0.5) AS median, round(avg({c}), 6) AS mean,
            round(corr(CAST(target AS DOUBLE), {c}), 6) AS corr_target FROM fx_application"""
        for c in ("ext_source_1", "ext_source_2", "ext_source_3")
    ),
)

# --- reports ----------------------------------------------------------------

add(
    "overview",
    "monthly",
    """SELECT count(*) AS rows, count(DISTINCT sk_id_curr) AS clients, count(DISTINCT sk_id_prev) AS contracts,
       min(months_balance) AS month_min, max(months_balance) AS month_max,
       count(*) / CAST(count(DISTINCT sk_id_prev) AS DOUBLE) AS rows_per_contract FROM fx_monthly""",
)
add(
    "overview_bureau",
    "bureau",
    """SELECT count(*) AS rows, count(DISTINCT sk_id_curr) AS clients, count(DISTINCT sk_id_bureau) AS credits,
       count(DISTINCT credit_type) AS credit_types, count(DISTINCT credit_active) AS credit_states,
       min(days_credit) AS days_credit_min, max(days_credit) AS days_credit_max,
       count(*) / CAST(count(DISTINCT sk_id_curr) AS DOUBLE) AS rows_per_client FROM fx_bureau""",
)
add("status_distribution", "monthly", distribution("fx_monthly", "name_contract_status", "name_contract_status"))
add(
    "credit_state_distribution",
    "bureau",
    distribution(
        "fx_bureau",
        """CASE lower(credit_active) WHEN 'active' THEN 'Active' WHEN 'closed' THEN 'Closed' WHEN 'sold' THEN 'Sold'
           WHEN 'bad debt' THEN 'Bad debt' WHEN 'bad_debt' THEN 'Bad debt' ELSE 'Other' END""",
        "credit_state",
    ),
)
add(
    "credit_type_distribution",
    "bureau",
    distribution("fx_bureau", "coalesce(credit_type, 'Unknown')", "credit_type", ", count(DISTINCT sk_id_curr) AS distinct_entities"),
)
BB_STATUS = "upper(coalesce(status, 'X'))"
BB_LATE = f"{BB_STATUS} IN ('1', '2', '3', '4', '5')"
add("balance_status_distribution", "bureau_balance", distribution("fx_bureau_balance", BB_STATUS, "status", f", {pct(BB_LATE)} AS late_pct"))
add(
    "previous_status_distribution",
    "previous",
    distribution("fx_previous", "name_contract_status", "name_contract_status", ", count(DISTINCT sk_id_curr) AS distinct_entities"),
)
add(
    "arrears_statistics",
    "monthly",
    f"""SELECT s.*, r.rows_in_arrears FROM ({summary("fx_monthly", ["sk_dpd", "sk_dpd_def"], {"median": 0.5, "p90": 0.9, "p99": 0.99})}) s
        JOIN (SELECT 'sk_dpd' AS variable, {n("sk_dpd > 0")} AS rows_in_arrears FROM fx_monthly
              UNION ALL SELECT 'sk_dpd_def', {n("sk_dpd_def > 0")} FROM fx_monthly) r ON s.variable = r.variable""",
)


def steps(value: str, edges: list[tuple[str, str]], rest: str, first: str = "") -> str:
    whens = " ".join(f"WHEN {value} <= {edge} THEN '{label}'" for edge, label in edges)
    return f"CASE {first} {whens} ELSE '{rest}' END"


DPD_EDGES = [("0", "0"), ("30", "1-30"), ("60", "31-60"), ("90", "61-90")]
add("bucket_distribution", "monthly", distribution("fx_monthly", steps("sk_dpd", DPD_EDGES, "90+"), "bucket"))
AMOUNT_BUCKET = steps(
    "amt_credit_sum",
    [("50000", "1 - 50k"), ("100000", "50k - 100k"), ("500000", "100k - 500k"), ("1000000", "500k - 1M")],
    "> 1M",
    "WHEN amt_credit_sum IS NULL THEN 'N/A' WHEN amt_credit_sum = 0 THEN '0'",
)
add("amount_buckets", "bureau", distribution("fx_bureau", AMOUNT_BUCKET, "bucket"))
OVERDUE_BUCKET = steps(
    "coalesce(credit_day_overdue, 0)",
    [("0", "not overdue"), ("30", "1-30 days"), ("60", "31-60 days"), ("90", "61-90 days")],
    "90+ days",
)
add(
    "overdue_distribution",
    "bureau",
    distribution("fx_bureau", OVERDUE_BUCKET, "bucket", f", {avg('amt_credit_sum_overdue')} AS avg_amt_overdue"),
)
UTIL_BUCKET = steps(
    "amt_balance / amt_credit_limit_actual",
    [("0.25e0", "0-25%"), ("0.5e0", "25-50%"), ("0.75e0", "50-75%"), ("1e0", "75-100%")],
    ">100%",
    "WHEN amt_credit_limit_actual <= 0 THEN 'no limit'",
)
add(
    "utilisation_distribution",
    "monthly",
    distribution("known", UTIL_BUCKET, "bucket"),
    "known AS (SELECT * FROM fx_monthly WHERE amt_balance IS NOT NULL AND amt_credit_limit_actual IS NOT NULL)",
)
add(
    "bucket_by_label",
    "monthly application",
    f"SELECT target, {steps('max_dpd', DPD_EDGES, '90+')} AS bucket, count(*) AS clients FROM posp GROUP BY 1, 2",
    POS_PROFILE_ROWS,
)
add(
    "utilisation_by_label",
    "monthly application",
    f"""SELECT target, {steps("utilisation_pct", [("25", "0-25%"), ("50", "25-50%"), ("75", "50-75%"), ("100", "75-100%")], ">100%",
        "WHEN utilisation_pct IS NULL THEN 'N/A'")} AS bucket, count(*) AS clients FROM ccp GROUP BY 1, 2""",
    CARD_PROFILE_ROWS,
)
add(
    "card_balance_statistics",
    "monthly",
    f"""SELECT min(amt_balance) AS min_balance, max(amt_balance) AS max_balance, {avg("amt_balance")} AS avg_balance,
        {avg("amt_credit_limit_actual")} AS avg_limit, {avg(f"({UTIL}) * 1e2")} AS avg_utilisation_pct
        FROM fx_monthly WHERE amt_balance IS NOT NULL AND amt_credit_limit_actual IS NOT NULL""",
)
add(
    "term_top20",
    "monthly",
    """SELECT CAST(cnt_instalment AS INT) AS term, count(*) AS n FROM fx_monthly WHERE cnt_instalment IS NOT NULL
       GROUP BY 1 ORDER BY n DESC, term LIMIT 20""",
)
add(
    "progress_summary",
    "monthly",
    f"""SELECT {avg("cnt_instalment")} AS avg_term, {avg("cnt_instalment_future")} AS avg_remaining,
        {avg("cnt_instalment - cnt_instalment_future")} AS avg_paid,
        {avg("CASE WHEN cnt_instalment > 0 THEN (cnt_instalment - cnt_instalment_future) / cnt_instalment END * 1e2")} AS avg_progress_pct
        FROM fx_monthly WHERE cnt_instalment IS NOT NULL AND cnt_instalment_future IS NOT NULL""",
)
add(
    "month_trend",
    "monthly",
    f"""SELECT months_balance, count(*) AS n, {n("sk_dpd > 0")} AS in_arrears, {pct("sk_dpd > 0")} AS arrears_pct,
        avg(sk_dpd) AS avg_dpd FROM fx_monthly GROUP BY 1""",
)
add(
    "card_trend",
    "monthly",
    f"""SELECT months_balance, count(*) AS n, {avg("amt_balance")} AS avg_balance, {avg(f"({UTIL}) * 1e2")} AS utilisation_pct,
        {avg("sk_dpd")} AS avg_dpd, {n("sk_dpd > 0")} AS in_arrears FROM fx_monthly GROUP BY 1""",
)
add(
    "balance_trend",
    "bureau_balance",
    f"""SELECT months_balance, count(*) AS n, {pct(BB_LATE)} AS late_pct, {pct(BB_STATUS + " = 'C'")} AS closed_pct,
        {pct(BB_STATUS + " = 'X'")} AS unknown_pct FROM fx_bureau_balance GROUP BY 1""",
)
add(
    "pos_label_summary",
    "monthly application",
    f"""SELECT target, count(*) AS clients, {", ".join(f"{avg(c)} AS avg_{c}" for c in
        ("total_snapshots", "pos_credits", "months_in_arrears", "max_dpd", "avg_dpd"))} FROM posp GROUP BY target""",
    POS_PROFILE_ROWS,
)
add(
    "card_label_summary",
    "monthly application",
    f"""SELECT target, count(*) AS clients, {", ".join(f"{avg(c)} AS mean_{c}" for c in
        ("cards", "avg_balance", "utilisation_pct", "months_in_arrears", "max_dpd", "pct_below_minimum"))} FROM ccp GROUP BY target""",
    CARD_PROFILE_ROWS,
)
add(
    "bureau_label_summary",
    "bureau application",
    f"""SELECT target, count(*) AS clients, {", ".join(f"{avg(c, 5)} AS avg_{c}" for c in (
        "bureau_credit_count", "bureau_total_credit_sum", "bureau_total_debt_sum", "bureau_total_overdue_sum",
        "bureau_overdue_credit_count", "bureau_max_credit_day_overdue", "bureau_debt_ratio_mean", "bureau_debt_ratio_max",
        "bureau_avg_credit_age_years", "bureau_oldest_update_days"))},
        CAST(quantile_disc(bureau_credit_count, 0.5) AS DOUBLE) AS med_bureau_credit_count,
        CAST(quantile_disc(bureau_credit_count, 0.9) AS DOUBLE) AS p90_bureau_credit_count
        FROM ({bureau_profile(None)}) GROUP BY target""",
)
add(
    "bureau_labelled_summary",
    "bureau application",
    f"""SELECT target, count(*) AS clients, {avg("records")} AS avg_records, {avg("total_debt")} AS avg_total_debt,
        {avg("active_credits")} AS avg_active_credits
        FROM fx_application LEFT JOIN (SELECT sk_id_curr, count(*) AS records, sum(amt_credit_sum_debt) AS total_debt,
          {n("credit_active = 'Active'")} AS active_credits FROM fx_bureau GROUP BY 1) USING (sk_id_curr) GROUP BY target""",
)
add(
    "balance_label_summary",
    "bureau_balance bureau application",
    f"""SELECT target, count(*) AS clients, {", ".join(f"{avg(c)} AS avg_{c}" for c in (
        "bb_total_snapshots", "bb_worst_status_numeric", "bb_delinquency_months", "bb_severe_delinquency_months",
        "bb_pct_delinquency_months", "bb_pct_unknown_months", "bb_pct_closed_months"))},
        CAST(quantile_disc(bb_total_snapshots, 0.5) AS DOUBLE) AS med_bb_total_snapshots,
        CAST(quantile_disc(bb_worst_status_numeric, 0.9) AS DOUBLE) AS p90_bb_worst_status_numeric
        FROM ({BALANCE_PROFILE}) GROUP BY target""",
    BB_ROWS,
)
add(
    "previous_label_summary",
    "application previous",
    f"""SELECT target, count(*) AS clients, {", ".join(f"{avg(c)} AS avg_{c}" for c in
        ("prev_num_applications", "prev_approved", "prev_refused"))}
        FROM fx_application LEFT JOIN ({PREVIOUS_SHORT}) USING (sk_id_curr) GROUP BY target""",
)
LATEST = """
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sk_id_curr, sk_id_prev
             ORDER BY months_balance DESC NULLS LAST, event_id DESC) AS rn FROM fx_monthly) WHERE rn = 1)
"""
add(
    "latest_snapshot",
    "monthly",
    "SELECT sk_id_curr, sk_id_prev, months_balance, event_id, name_contract_status, amt_balance FROM latest",
    LATEST,
)
add(
    "last_status_by_label",
    "monthly application",
    """SELECT name_contract_status, target, count(DISTINCT l.sk_id_curr) AS clients, count(*) AS contracts
       FROM latest l JOIN fx_application t ON l.sk_id_curr = t.sk_id_curr GROUP BY 1, 2""",
    LATEST,
)
add(
    "last_status_pivot",
    "monthly application",
    f"""SELECT name_contract_status, {n("target = 0")} AS negatives, {n("target = 1")} AS positives, {pct("target = 1")} AS rate_pct
        FROM latest l JOIN fx_application t ON l.sk_id_curr = t.sk_id_curr GROUP BY 1""",
    LATEST,
)
add(
    "payments_summary",
    "monthly",
    f"""SELECT {avg("amt_drawings_current")} AS avg_drawings, {avg("amt_drawings_atm_current")} AS avg_atm,
        {avg("amt_drawings_pos_current")} AS avg_pos, {avg("amt_drawings_other_current")} AS avg_other,
        {avg("amt_payment_current")} AS avg_payment, {avg("amt_inst_min_regularity")} AS avg_minimum,
        {pct("amt_payment_current < amt_inst_min_regularity")} AS pct_below_minimum FROM fx_monthly""",
)
add(
    "amount_mix",
    "monthly",
    " UNION ALL ".join(
        f"SELECT '{ch}' AS channel, round(sum({c}), 4) AS total_amount FROM fx_monthly WHERE {c} > 0"
        for ch, c in (("ATM", "amt_drawings_atm_current"), ("POS", "amt_drawings_pos_current"), ("Other", "amt_drawings_other_current"))
    ),
)
add(
    "arrears_by_status",
    "monthly",
    f"""SELECT name_contract_status, count(*) AS n, {n("sk_dpd > 0")} AS in_arrears, {pct("sk_dpd > 0")} AS arrears_pct,
        {avg("sk_dpd")} AS avg_dpd, max(sk_dpd) AS max_dpd FROM fx_monthly GROUP BY 1""",
)
OD = "coalesce(credit_day_overdue, 0)"
add(
    "overdue_global",
    "bureau",
    f"""SELECT count(*) AS credits, {n(OD + " > 0")} AS overdue_credits, round({pct(OD + " > 0")}, 6) AS overdue_pct,
        {avg(OD)} AS avg_days_overdue, {avg("coalesce(amt_credit_sum_overdue, 0)")} AS avg_amt_overdue FROM fx_bureau""",
)
add(
    "overdue_by_type",
    "bureau",
    f"""SELECT coalesce(credit_type, 'Unknown') AS credit_type, count(*) AS n, {n(OD + " > 0")} AS in_arrears,
        {pct(OD + " > 0")} AS arrears_pct, {avg(OD)} AS avg_days_overdue,
        round(sum(coalesce(amt_credit_sum_overdue, 0)), 2) AS total_amt_overdue FROM fx_bureau GROUP BY 1""",
)
add(
    "overdue_by_state",
    "bureau",
    f"""SELECT coalesce(credit_active, 'Unknown') AS credit_active, count(*) AS n, {n(OD + " > 0")} AS in_arrears,
        {pct(OD + " > 0")} AS arrears_pct FROM fx_bureau GROUP BY 1""",
)
add(
    "coverage_by_label",
    "application previous monthly",
    f"""SELECT CASE WHEN p AND m THEN 'both' WHEN p THEN 'only previous' WHEN m THEN 'only monthly' ELSE 'none' END AS coverage,
        {n("target = 0")} AS negatives, {n("target = 1")} AS positives, {pct("target = 1")} AS default_rate_pct
        FROM (SELECT target, sk_id_curr IN (SELECT sk_id_curr FROM fx_previous) AS p,
                sk_id_curr IN (SELECT sk_id_curr FROM fx_monthly) AS m FROM fx_application) GROUP BY 1""",
)
add(
    "temporal_summary",
    "bureau application",
    f"""SELECT target, count(*) AS credits, {avg("-days_credit / 365e0")} AS avg_credit_age_years,
        {avg("days_credit_enddate / 365e0")} AS avg_expected_remaining_years, {avg("-days_enddate_fact / 365e0")} AS avg_actual_end_years,
        {avg("-days_credit_update / 365e0")} AS avg_update_age_years,
        quantile_disc(-days_credit / 365e0, 0.5) AS median_credit_age_years
        FROM fx_bureau b LEFT JOIN (SELECT sk_id_curr, target FROM fx_application) t
          ON b.sk_id_curr = t.sk_id_curr GROUP BY target""",
)
COMBINED = f"""
cp AS ({bureau_profile(6)}), bp AS ({BALANCE_PROFILE}),
combined AS (SELECT * FROM cp LEFT JOIN bp USING (sk_id_curr, target))
"""
add("combined_frame", "bureau bureau_balance application", "SELECT * FROM combined", BB_ROWS + "," + COMBINED)
add(
    "severity_rate",
    "bureau bureau_balance application",
    f"""SELECT {steps("coalesce(bb_worst_status_numeric, 0)", [("0", "no past arrears"), ("2", "mild past arrears")], "severe past arrears")} AS severity,
        count(*) AS clients, {n("target = 1")} AS defaults, {pct("target = 1")} AS default_rate_pct FROM combined GROUP BY 1""",
    BB_ROWS + "," + COMBINED,
)
add(
    "age_income_by_label",
    "application",
    f"""SELECT target, count(*) AS clients, {avg("abs(days_birth) / 365e0")} AS avg_age_years, {avg("amt_income_total")} AS avg_income,
        quantile_disc(abs(days_birth) / 365e0, 0.5) AS median_age_years, quantile_disc(amt_income_total, 0.5) AS median_income
        FROM fx_application GROUP BY target""",
)
add(
    "financial_ratios",
    "bureau",
    "SELECT variable, n, nulls, round(min, 6) AS min, mean, round(max, 6) AS max, round(median, 6) AS median, round(p90, 6) AS p90 FROM ("
    + summary("ratios", ["debt_ratio", "overdue_ratio", "limit_ratio"], {"median": 0.5, "p90": 0.9})
    + ")",
    """ratios AS (SELECT CASE WHEN amt_credit_sum > 0 THEN amt_credit_sum_debt / amt_credit_sum END AS debt_ratio,
        CASE WHEN amt_credit_sum > 0 THEN amt_credit_sum_overdue / amt_credit_sum END AS overdue_ratio,
        CASE WHEN amt_credit_sum > 0 THEN amt_credit_sum_limit / amt_credit_sum END AS limit_ratio FROM fx_bureau)""",
)

# --- cleaning and row features ---------------------------------------------

SENTINEL = "CASE WHEN days_employed <> 365243 THEN days_employed END"
add(
    "clean_table",
    "application",
    f"SELECT * EXCLUDE (ext_source_1, mostly_null) REPLACE ({SENTINEL} AS days_employed) FROM fx_application",
)
add(
    "null_sentinel",
    "application",
    f"""SELECT sk_id_curr, {SENTINEL} AS days_employed, CASE WHEN days_employed = 365243 THEN 1 ELSE 0 END AS days_employed_was_sentinel
        FROM fx_application""",
)
DAY_COLUMNS = {
    "days_birth": ("age_years", ">="), "days_employed": ("employment_years", ">"), "days_registration": ("registration_years", ">"),
}


def anomaly(c: str, op: str) -> str:
    return f"({c} {op} 0 OR {c} = 365243)"


add(
    "null_anomaly",
    "application",
    "SELECT sk_id_curr, "
    + ", ".join(
        f"""CASE WHEN NOT {anomaly(c, op)} THEN {c} END AS {c}, CASE WHEN {anomaly(c, op)} THEN 1 ELSE 0 END AS {c}_anom_flag,
            CASE WHEN NOT {anomaly(c, op)} THEN -{c} / 365e0 END AS {years}"""
        for c, (years, op) in DAY_COLUMNS.items()
    )
    + " FROM fx_application",
)
FLAGGED = [
    "obs_30_cnt_social_circle", "def_30_cnt_social_circle", "ext_source_2", "ext_source_3", "days_employed", "amt_annuity",
    "amt_goods_price", "cnt_fam_members", "amt_req_credit_bureau_mon", "amt_req_credit_bureau_year",
]
FLAG_COLUMNS = ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing_flag" for c in FLAGGED)
add("missing_flags", "application", f"SELECT sk_id_curr, {FLAG_COLUMNS} FROM fx_application")
add(
    "fill_strings",
    "application",
    """SELECT sk_id_curr, CASE WHEN name_education_type IS NULL OR trim(name_education_type) = '' THEN 'UNKNOW'
       ELSE name_education_type END AS name_education_type, code_gender FROM fx_application""",
)
add(
    "normalize_category",
    "application",
    "SELECT sk_id_curr, CASE WHEN code_gender = 'XNA' THEN 'Unknown' ELSE code_gender END AS code_gender FROM fx_application",
)
HASH = "(('0x' || substr(md5(CAST(sk_id_curr AS VARCHAR)), 1, 13))::BIGINT / 4503599627370496e0)"
add(
    "median_impute",
    "application",
    f"""SELECT sk_id_curr, {", ".join(f"{fill(c, 'train')} AS {c}, CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS flag_missing_{c}" for c in AMOUNTS)}
        FROM fx_application""",
    f"train AS (SELECT * FROM fx_application WHERE {HASH} < 0.8e0)",
)
add(
    "constant_impute",
    "application",
    "SELECT sk_id_curr, coalesce(ext_source_1, 0) AS ext_source_1, coalesce(mostly_null, 0) AS mostly_null FROM fx_application",
)
add("drop_constant", "application", "SELECT * EXCLUDE (flag_document_2) FROM fx_application")
add("drop_sparse", "application", "SELECT * EXCLUDE (ext_source_1, mostly_null) FROM fx_application")
SPARSE = ["amt_annuity", "amt_goods_price", "cnt_fam_members", "ext_source_1", "ext_source_2", "ext_source_3"]
add(
    "drop_sparse_rows",
    "application",
    f"""SELECT sk_id_curr, {", ".join(SPARSE)} FROM fx_application
        WHERE ({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in SPARSE)}) / 7e0 <= 0.3e0""",
)
add("drop_document_flags", "application", "SELECT sk_id_curr, flag_own_car, flag_phone, flag_email FROM fx_application")
add(
    "row_predicates",
    "monthly",
    """SELECT event_id, sk_id_curr, sk_dpd, months_balance FROM fx_monthly WHERE sk_id_curr IS NOT NULL AND sk_id_prev IS NOT NULL
       AND sk_dpd BETWEEN 1 AND 90 AND months_balance IN (-1, -2, -3, -10) AND amt_payment_current IS NOT NULL
       AND amt_payment_current < amt_balance""",
)
RATIOS = {
    "credit_income_ratio": "amt_credit / (amt_income_total + 1)",
    "annuity_income_ratio": "amt_annuity / (amt_income_total + 1)",
    "annuity_credit_ratio": "amt_annuity / (amt_credit + 1)",
    "goods_credit_ratio": "amt_goods_price / (amt_credit + 1)",
    "income_per_family_member": "amt_income_total / (coalesce(cnt_fam_members, 1) + 1)",
    "income_per_child": "amt_income_total / (cnt_children + 1)",
    "children_family_ratio": "cnt_children / (coalesce(cnt_fam_members, 1) + 1e-6)",
    "social_def_ratio": "coalesce(def_30_cnt_social_circle, 0) / (coalesce(obs_30_cnt_social_circle, 0) + 1)",
}
add(
    "safe_ratios",
    "application",
    f"""SELECT sk_id_curr, amt_goods_price / nullif(amt_credit, 0) AS goods_credit,
        CASE WHEN amt_credit > 0 THEN amt_goods_price / amt_credit END AS goods_credit_positive,
        {", ".join(f"{e} AS {c}" for c, e in RATIOS.items())} FROM fx_application""",
)
add(
    "payment_rows",
    "installments",
    f"""SELECT sk_id_prev, num_instalment_number, {DELAY} AS delay, greatest({DELAY}, 0) AS dpd,
        CASE WHEN {DELAY} IS NOT NULL THEN greatest({DELAY}, 0) END AS dpd_null_safe,
        round(least(amt_payment / nullif(amt_instalment, 0), 3), 9) AS ratio_capped,
        round(CASE WHEN amt_payment / nullif(amt_instalment, 0) IS NOT NULL THEN least(amt_payment / nullif(amt_instalment, 0), 1) END, 9) AS ratio_null_safe,
        CASE WHEN {DELAY} > 30 THEN 1 ELSE 0 END AS late_30 FROM fx_installments""",
)
add(
    "value_maps",
    "previous",
    """SELECT sk_id_prev, CASE WHEN sellerplace_area > 0 THEN sellerplace_area END AS area_positive,
       CASE flag_last_appl_per_contract WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS last_flag FROM fx_previous""",
)
add(
    "status_numbers",
    "bureau_balance",
    f"SELECT {BB_STATUS} AS status, TRY_CAST({BB_STATUS} AS INT) AS level, count(*) AS n FROM fx_bureau_balance GROUP BY 1, 2",
)
add(
    "row_stats_query",
    "application",
    f"""SELECT sk_id_curr, round({EXT_MEAN}, 6) AS ext_sources_mean, {EXT_MIN} AS ext_sources_min, {EXT_MAX} AS ext_sources_max,
        round({EXT_STD}, 6) AS ext_sources_std FROM fx_application""",
)
add(
    "row_sums",
    "application",
    """SELECT sk_id_curr, coalesce(amt_req_credit_bureau_mon, 0) + coalesce(amt_req_credit_bureau_year, 0) AS requests,
       coalesce(obs_30_cnt_social_circle, 0) + coalesce(def_30_cnt_social_circle, 0) AS social FROM fx_application""",
)
add(
    "row_count_flags_query",
    "application",
    """SELECT sk_id_curr, flag_phone + flag_email AS contacts, reg_city_not_live_city + reg_city_not_work_city AS mismatches,
       flag_document_2 + flag_document_3 + least(cnt_children, 1) AS documents FROM fx_application""",
)
add(
    "years_and_buckets",
    "application",
    f"""SELECT sk_id_curr, abs(days_birth) / 365e0 AS age_years,
        {steps("amt_income_total", [("50000", "low"), ("100000", "mid"), ("150000", "high")], "top")} AS income_class FROM fx_application""",
)


def cap(c: str, q: float, source: str = "fx_application") -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN least({c}, (SELECT quantile_disc({c}, {q}) FROM {source})) END"


add(
    "learned_caps",
    "application",
    f"""SELECT sk_id_curr, {", ".join(f"{cap(c, 0.9)} AS {c}_cap, round(ln(1 + {cap(c, 0.9)}), 6) AS {c}_log" for c in AMOUNTS)}
        FROM fx_application""",
)

WIDE_COUNTS = [
    "cnt_children", "cnt_fam_members", "obs_30_cnt_social_circle", "def_30_cnt_social_circle", "amt_req_credit_bureau_mon",
    "amt_req_credit_bureau_year",
]
WIDE_RATIOS = RATIOS | {"employment_age_ratio": "employment_years / (age_years + 1e-6)"}
ONE_HOT = {
    "name_contract_type": ["Cash loans", "Revolving loans"],
    "code_gender": ["F", "M", "XNA"],
    "flag_own_car": ["N", "Y"],
    "name_education_type": [" ", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


def indicators(column: str, with_null: bool = True) -> str:
    names = {v: slug(v.strip()) or "empty" for v in ONE_HOT[column]}
    cells = [f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS {column}_{name}" for v, name in names.items()]
    if with_null:
        cells.append(f"CASE WHEN {column} IS NULL THEN 1 ELSE 0 END AS {column}_nan")
    return ", ".join(cells)


WIDE_CTES = f"""
s0 AS (SELECT * REPLACE ({", ".join(f"CASE WHEN NOT {anomaly(c, op)} THEN {c} END AS {c}" for c, (_, op) in DAY_COLUMNS.items())}),
  {", ".join(f"CASE WHEN NOT {anomaly(c, op)} THEN -{c} / 365e0 END AS {y}" for c, (y, op) in DAY_COLUMNS.items())},
  {", ".join(f"CASE WHEN {anomaly(c, op)} THEN 1 ELSE 0 END AS {c}_anom_flag" for c, (_, op) in DAY_COLUMNS.items() if c != "days_birth")},
  {", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing_flag" for c in FLAGGED if c != "days_employed")}
  FROM fx_application),
s1 AS (SELECT *, {", ".join(f"{e} AS {r}_raw" for r, e in WIDE_RATIOS.items())} FROM s0)
"""
add(
    "application_features",
    "application",
    f"""SELECT * EXCLUDE (flag_document_2, {", ".join(ONE_HOT)}, {", ".join(f"{r}_raw" for r in WIDE_RATIOS)}),
        {", ".join(f"{cap(c, 0.995, 's0')} AS {c}_cap, round(ln(1 + {cap(c, 0.995, 's0')}), 6) AS {c}_log" for c in AMOUNTS)},
        {", ".join(f"{cap(c, 0.99, 's0')} AS {c}_cap" for c in WIDE_COUNTS)},
        {", ".join(f"{cap(r + '_raw', 0.995, 's1')} AS {r}" for r in WIDE_RATIOS)},
        round({EXT_MEAN}, 6) AS ext_sources_mean, {EXT_MIN} AS ext_sources_min, {EXT_MAX} AS ext_sources_max,
        round({EXT_STD}, 6) AS ext_sources_std,
        coalesce(amt_req_credit_bureau_mon, 0) + coalesce(amt_req_credit_bureau_year, 0) AS bureau_requests_total,
        coalesce(amt_req_credit_bureau_mon, 0) AS bureau_requests_recent,
        coalesce(obs_30_cnt_social_circle, 0) AS social_obs_total, coalesce(def_30_cnt_social_circle, 0) AS social_def_total,
        flag_phone + flag_email AS num_contact_channels, reg_city_not_live_city + reg_city_not_work_city AS address_mismatch_count,
        flag_document_2 + flag_document_3 AS num_documents_provided,
        {", ".join(indicators(c, c == "name_education_type") for c in ONE_HOT)} FROM s1""",
    WIDE_CTES,
)
add(
    "model_features",
    "application previous installments",
    f"""SELECT a.sk_id_curr, a.target, {cap("income_per_child_raw", 0.995, "s1")} AS income_per_child, p.previous_count,
        p.days_decision_median, p.goods_credit_ratio_median, c.name_client_type_1_urgent, c.name_contract_status_approved,
        i.installments_count, i.dpd_median, i.late_payment_mean
        FROM s1 a LEFT JOIN ({PREVIOUS_NUMERIC}) p ON a.sk_id_curr = p.sk_id_curr
        LEFT JOIN (SELECT sk_id_curr, avg(CASE WHEN name_client_type = '1-URGENT' THEN 1e0 ELSE 0e0 END) AS name_client_type_1_urgent,
            avg(CASE WHEN name_contract_status = 'Approved' THEN 1e0 ELSE 0e0 END) AS name_contract_status_approved
          FROM fx_previous GROUP BY 1) c ON a.sk_id_curr = c.sk_id_curr
        LEFT JOIN ({BEHAVIOUR}) i ON a.sk_id_curr = i.sk_id_curr""",
    WIDE_CTES + "," + BEHAVIOUR_ROWS,
)

# --- encoding and splits ----------------------------------------------------

HOT = ["code_gender", "flag_own_car", "name_education_type"]
add("one_hot", "application", f"SELECT sk_id_curr, {', '.join(indicators(c) for c in HOT)} FROM fx_application")


def position(column: str) -> str:
    """Alphabetical position, null after the last value."""
    return f"""CAST(CASE WHEN {column} IS NULL THEN (SELECT count(DISTINCT {column}) FROM fx_application)
        ELSE (SELECT pos FROM pos_{column} x WHERE x.v = {column}) END AS DOUBLE) AS {column}_idx"""


def positions(column: str) -> str:
    return f"""pos_{column} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS pos
        FROM (SELECT DISTINCT {column} AS v FROM fx_application WHERE {column} IS NOT NULL))"""


add(
    "label_index",
    "application",
    f"SELECT sk_id_curr, {position('organization_type')}, {position('name_education_type')} FROM fx_application",
    f"{positions('organization_type')}, {positions('name_education_type')}",
)
add(
    "label_index_table",
    "application",
    f"SELECT sk_id_curr, {position('organization_type')} FROM fx_application",
    positions("organization_type"),
)
add(
    "encode_mixed",
    "application",
    f"""SELECT sk_id_curr, target, {indicators("code_gender", False)}, {indicators("name_education_type")},
        {position("organization_type")} FROM fx_application""",
    positions("organization_type"),
)
add("hash_split", "application", f"SELECT sk_id_curr FROM fx_application WHERE {HASH} < 0.8e0")
add(
    "stratified_split",
    "application",
    """SELECT sk_id_curr, h.target, u <= t.threshold AS in_train FROM h JOIN
       (SELECT target, quantile_disc(u, 0.8) AS threshold FROM h GROUP BY target) t ON h.target = t.target""",
    f"h AS (SELECT sk_id_curr, target, {HASH} AS u FROM fx_application)",
)
add(
    "class_weights",
    "application",
    """SELECT sk_id_curr, a.target, (SELECT count(*) FROM fx_application) / (2e0 * c.n) AS class_weight
       FROM fx_application a JOIN (SELECT target, count(*) AS n FROM fx_application GROUP BY target) c ON a.target = c.target""",
)
add(
    "unpivot_amounts",
    "application",
    " UNION ALL ".join(f"SELECT sk_id_curr, '{c}' AS variable, {c} AS value FROM fx_application" for c in AMOUNTS),
)
add(
    "skew_join",
    "application monthly",
    "SELECT event_id, m.sk_id_curr, target FROM fx_monthly m JOIN fx_application t ON m.sk_id_curr = t.sk_id_curr",
)
add(
    "bridge_join",
    "bureau_balance bureau",
    """SELECT s.sk_id_bureau, months_balance, count(*) AS rows, sk_id_curr
       FROM fx_bureau_balance s JOIN fx_bureau b ON s.sk_id_bureau = b.sk_id_bureau GROUP BY ALL""",
)

# --- models -----------------------------------------------------------------

add(
    "rank_features_pearson",
    "application",
    "SELECT *, abs(pearson_corr) AS abs_pearson_corr FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr(coalesce({c}, 0), CAST(target AS DOUBLE)), 6) AS pearson_corr FROM fx_application"
        for c in CORR
    )
    + ")",
)


def chi(c: str) -> str:
    a, b = f"count(*) FILTER (WHERE {c} = 1 AND target = 1)", f"count(*) FILTER (WHERE {c} = 1 AND target = 0)"
    d, e = f"count(*) FILTER (WHERE {c} = 0 AND target = 1)", f"count(*) FILTER (WHERE {c} = 0 AND target = 0)"
    return f"""SELECT '{c}' AS feature, CAST({a} AS DOUBLE) AS a, {b} AS b, {d} AS d, {e} AS e FROM fx_application"""


def chi_sql(cols: list[str]) -> str:
    return f"""SELECT feature, round(coalesce((a + b + d + e) * (a * e - b * d) * (a * e - b * d)
        / nullif((a + b) * (d + e) * (a + d) * (b + e), 0), 0), 6) AS statistic FROM ({" UNION ALL ".join(chi(c) for c in cols)})"""


add("rank_features_chi_square", "application", chi_sql(["flag_phone", "flag_email", "flag_document_3"]))
add(
    "score_auc",
    "application",
    """SELECT round((sum(mean_rank) FILTER (WHERE target = 1) - p * (p + 1) / 2e0) / (p * (count(*) - p)), 6) AS auc FROM (
         SELECT target, first_rank + (ties - 1) / 2e0 AS mean_rank, CAST(sum(target) OVER () AS DOUBLE) AS p FROM (
           SELECT target, rank() OVER (ORDER BY s) AS first_rank, count(*) OVER (PARTITION BY s) AS ties FROM (
             SELECT target, amt_income_total / 2e5 + sk_id_curr % 3 AS s FROM fx_application))) GROUP BY p""",
)
TAIL = """(-z * z + ln(t) + (-1.26551223 + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * (-0.18628806 + t * (0.27886807
    + t * (-1.13520398 + t * (1.48851587 + t * (-0.82215223 + t * 0.17087277))))))))))"""
add(
    "rank_features_p_values",
    "application",
    f"""SELECT feature, statistic, round(least(exp(e), 1e0), 6) AS p_value, round(greatest(-e / ln(10e0), 0e0), 6) AS neg_log10_p
        FROM (SELECT *, {TAIL} AS e FROM (SELECT *, 1e0 / (1e0 + z / 2) AS t FROM (SELECT *, sqrt(statistic / 2) AS z FROM
          ({chi_sql(["flag_phone", "flag_email", "flag_document_3"])}))))""",
)
add("bernoulli_sample", "application", "SELECT sk_id_curr FROM fx_application WHERE " + HASH.replace("md5(CAST", "md5('42' || CAST") + " < 0.2e0")
add(
    "long_shares",
    "previous",
    """SELECT name_contract_status, variable, value, round(n / sum(n) OVER (PARTITION BY name_contract_status, variable), 9) AS share FROM (
         SELECT name_contract_status, 'decided' AS variable, CAST(days_decision AS VARCHAR) AS value, count(*) AS n FROM fx_previous GROUP BY ALL
         UNION ALL SELECT name_contract_status, 'name_client_type', name_client_type, count(*) FROM fx_previous GROUP BY ALL)""",
)
add("chi_square_table", "application", chi_sql(["flag_phone", "flag_email", "flag_document_2", "flag_document_3"]))

PRED = """
pred AS (SELECT sk_id_curr, target, CAST(target AS DOUBLE) AS label,
  CASE WHEN sk_id_curr % 9 = 0 OR amt_income_total < 5e4 THEN 1e0 ELSE 0e0 END AS prediction FROM fx_application),
cm AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM pred)
"""
add(
    "rule_metrics",
    "application",
    """SELECT 'rule' AS model, 'accuracy' AS metric, round((tp + tn) / (tp + tn + fp + fn), 9) AS value FROM cm
       UNION ALL SELECT 'rule', 'precision', round(tp / (tp + fp), 9) FROM cm
       UNION ALL SELECT 'rule', 'recall', round(tp / (tp + fn), 9) FROM cm
       UNION ALL SELECT 'rule', 'f1_score', round(2 * tp / (2 * tp + fp + fn), 9) FROM cm""",
    PRED,
)
add("confusion_counts", "application", "SELECT label, prediction, count(*) AS count FROM pred GROUP BY 1, 2", PRED)
OUTCOMES = [
    ("TP", "default", "predicted default", "tp", "tp + fn"),
    ("TN", "no default", "predicted no default", "tn", "tn + fp"),
    ("FP", "no default", "predicted default", "fp", "tn + fp"),
    ("FN", "default", "predicted no default", "fn", "tp + fn"),
]
REPORT = " UNION ALL ".join(
    f"""SELECT 'rule' AS model, '{o}' AS outcome, '{t}' AS true_class, '{p}' AS predicted_class, CAST({c} AS BIGINT) AS count,
        {c} * 1e2 / (tp + tn + fp + fn) AS pct_of_total, {c} * 1e2 / ({size}) AS pct_of_true_class FROM cm"""
    for o, t, p, c, size in OUTCOMES
)
add("confusion_report", "application", REPORT, PRED)
add(
    "confusion_pivot",
    "application",
    f"""SELECT true_class, sum(CASE WHEN predicted_class = 'predicted no default' THEN pct_of_true_class ELSE 0 END) AS predicted_no_default,
        sum(CASE WHEN predicted_class = 'predicted default' THEN pct_of_true_class ELSE 0 END) AS predicted_default
        FROM ({REPORT}) GROUP BY 1""",
    PRED,
)
add(
    "actual_vs_predicted",
    "application",
    """SELECT CASE target WHEN 0 THEN 'actual: no default' WHEN 1 THEN 'actual: default' END AS actual,
       CASE prediction WHEN 0 THEN 'predicted: no default' WHEN 1 THEN 'predicted: default' END AS predicted, count(*) AS count
       FROM pred GROUP BY 1, 2""",
    PRED,
)
add(
    "positive_probabilities",
    "application",
    """SELECT sk_id_curr, round(coalesce(ext_source_2, 0), 3) AS from_array, round(coalesce(ext_source_2, 0), 3) AS from_text
       FROM fx_application""",
)


from creditloom.plans import lake_oracle  # noqa: E402, F401  adds its statements
