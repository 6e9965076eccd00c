"""Feature blocks: each satellite table to one row per client.

Absent input columns count as null. ``Rounding`` gives the decimals of averages
(money), of shares and ratios (share) and of sums (total); ``None`` leaves them
unrounded.
Every block is one aggregation by client; conditions over the same rows share it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import (
    clip, days_to_years, keep_if, map_values, positive_part, safe_ratio, status_number,
)
from creditloom.operators.cleaning import category, ensure_columns, require_keys, valid_label
from creditloom.operators.encoding import category_shares
from creditloom.operators.entity import Metric, entity_aggregate
from creditloom.operators.joins import attach, bridge_join, count_rows

KEY = "sk_id_curr"
LATE_STATUSES = ("1", "2", "3", "4", "5")
SEVERE_STATUSES = ("3", "4", "5")


@dataclass(frozen=True)
class Rounding:
    money: int | None = 4
    share: int | None = 6
    total: int | None = 4


DEFAULT = Rounding()


def count(name: str, where: Column | None = None) -> Metric:
    return Metric(name, "count", where=where)


def share(name: str, where: Column, r: Rounding) -> Metric:
    return Metric(name, "share", where=where, digits=r.share)


def status(column: str, missing: str) -> Column:
    """Upper-cased status with a stand-in for null."""
    return category(column, null_as=missing, case="upper")


# --- bureau -----------------------------------------------------------------

BUREAU_COLUMNS = {
    "sk_id_curr": "bigint", "sk_id_bureau": "bigint", "credit_active": "string", "credit_type": "string",
    "days_credit": "int", "days_credit_enddate": "double", "days_enddate_fact": "double",
    "credit_day_overdue": "int", "amt_credit_sum": "double", "amt_credit_sum_debt": "double",
    "amt_credit_sum_limit": "double", "amt_credit_sum_overdue": "double", "days_credit_update": "int",
    "cnt_credit_prolong": "int",
}


def bureau_features(bureau: DataFrame, r: Rounding = DEFAULT) -> DataFrame:
    state = category("credit_active", null_as="unknown", case="lower")
    end, fact = F.col("days_credit_enddate"), F.col("days_enddate_fact")
    active = state == "active"
    recent = F.col("days_credit").between(-365, 0)
    metrics = [
        count("bureau_num_records"),
        count("bureau_active_credits", active),
        count("bureau_closed_credits", state == "closed"),
        count("bureau_bad_debt_credits", state.isin("bad debt", "bad_debt")),
        Metric("bureau_total_credit_sum", "sum0", "amt_credit_sum", digits=r.total),
        Metric("bureau_avg_credit_sum", "avg", "amt_credit_sum", digits=r.money),
        Metric("bureau_total_debt", "sum0", "amt_credit_sum_debt", digits=r.total),
        Metric("bureau_total_overdue", "sum0", "amt_credit_sum_overdue", digits=r.total),
        Metric("bureau_max_days_overdue", "max", F.coalesce("credit_day_overdue", F.lit(0))),
        Metric("bureau_avg_days_credit", "avg", "days_credit", digits=r.money),
        count("bureau_recent_credits_1y", recent),
        share("bureau_pct_recent_credits_1y", recent, r),
        count("bureau_missing_days_credit_enddate", end.isNull()),
        share("bureau_pct_missing_days_credit_enddate", end.isNull(), r),
        count("bureau_expected_enddate_past", end < 0),
        count("bureau_expected_enddate_future", end >= 0),
        Metric("flag_active_with_enddate_fact", "any", where=active & fact.isNotNull()),
        share("pct_active_with_enddate_fact", active & fact.isNotNull(), r),
        count("active_expected_enddate_past_count", active & (end < 0)),
    ]
    return entity_aggregate(ensure_columns(bureau, BUREAU_COLUMNS), KEY, metrics)


def bureau_summary(bureau: DataFrame, digits: int | None = 2, total: int | None = 2) -> DataFrame:
    """Short exploratory variant: plain sums, statuses taken literally."""
    state = F.col("credit_active")
    return entity_aggregate(
        ensure_columns(bureau, BUREAU_COLUMNS),
        KEY,
        [
            count("bureau_num_records"),
            count("bureau_active_credits", state == "Active"),
            count("bureau_closed_credits", state == "Closed"),
            count("bureau_bad_debt_credits", state == "Bad debt"),
            Metric("bureau_avg_credit_sum", "avg", "amt_credit_sum", digits=digits),
            Metric("bureau_total_credit_sum", "sum", "amt_credit_sum", digits=total),
            Metric("bureau_total_debt", "sum", "amt_credit_sum_debt", digits=total),
            Metric("bureau_max_days_overdue", "max", "credit_day_overdue"),
            Metric("bureau_avg_days_credit", "avg", "days_credit", digits=digits),
        ],
    )


def bureau_client_profile(bureau: DataFrame, labels: DataFrame, label: str = "target", money: int | None = 2,
                          years: int | None = 4, ratio: int | None = 6) -> DataFrame:
    """Client profile with debt ratio and label.

    Clients are aggregated before they meet the label, which is unique per
    client, so the join never sees single credits. ``days_credit_update`` is a
    negative offset: the minimum is the oldest update, the maximum the latest.
    """
    df = ensure_columns(bureau, BUREAU_COLUMNS)
    state = F.lower("credit_active")
    overdue_days = F.coalesce("credit_day_overdue", F.lit(0))
    debt_ratio = safe_ratio("amt_credit_sum_debt", "amt_credit_sum", "positive")
    metrics = [
        count("bureau_credit_count"),
        count("bureau_active_credit_count", state == "active"),
        count("bureau_closed_credit_count", state == "closed"),
        Metric("bureau_credit_type_count", "count_distinct", "credit_type"),
        Metric("bureau_total_credit_sum", "sum0", "amt_credit_sum", digits=money),
        Metric("bureau_total_debt_sum", "sum0", "amt_credit_sum_debt", digits=money),
        Metric("bureau_total_overdue_sum", "sum0", "amt_credit_sum_overdue", digits=money),
        Metric("bureau_max_credit_day_overdue", "max", overdue_days),
        Metric("bureau_avg_credit_age_years", "avg", days_to_years("days_credit", "neg"), digits=years),
        Metric("bureau_debt_ratio_max", "max", debt_ratio, digits=ratio),
        Metric("bureau_debt_ratio_mean", "avg", debt_ratio, digits=ratio),
        Metric("bureau_cnt_credit_prolong_sum", "sum0", "cnt_credit_prolong"),
        count("bureau_overdue_credit_count", overdue_days > 0),
        Metric("bureau_oldest_update_days", "min", "days_credit_update"),
        Metric("bureau_latest_update_days", "max", "days_credit_update"),
    ]
    return entity_aggregate(df, KEY, metrics).join(labels.select(KEY, label), KEY, "inner")


# --- bureau balance ---------------------------------------------------------

BALANCE_COLUMNS = {"sk_id_bureau": "bigint", "months_balance": "int", "status": "string"}


def _client_months(snapshots: DataFrame, credits: DataFrame) -> DataFrame:
    """(client, month, status, rows): snapshots are counted per credit, month
    and status before the join, so a credit with very many snapshots arrives as
    at most months x statuses rows."""
    df = ensure_columns(snapshots, BALANCE_COLUMNS)
    known = df.select("sk_id_bureau", "months_balance", status("status", "X").alias("status"))
    return bridge_join(count_rows(known, ["sk_id_bureau", "months_balance", "status"]), credits, "sk_id_bureau", KEY)


def _weight(name: str, where: Column | None = None) -> Metric:
    rows = F.col("rows") if where is None else F.when(where, F.col("rows")).otherwise(F.lit(0))
    return Metric(name, "sum", rows)


def _rate(part: str, total: str, name: str, scale: float, digits: int | None) -> tuple[str, Column]:
    value = F.col(part) * F.lit(scale) / F.col(total)
    return name, (F.round(value, digits) if digits is not None else value)


def balance_features(snapshots: DataFrame, credits: DataFrame, r: Rounding = DEFAULT) -> DataFrame:
    s = F.col("status")
    counted = entity_aggregate(
        _client_months(snapshots, credits),
        KEY,
        [
            _weight("bb_total_snapshots"),
            Metric("bb_num_months", "count_distinct", "months_balance"),
            _weight("bb_num_closed", s == "C"),
            _weight("bb_num_status_0", s == "0"),
            _weight("bb_num_status_1_5", s.isin(*LATE_STATUSES)),
            _weight("bb_num_status_c", s == "C"),
            _weight("bb_num_status_x", s == "X"),
            Metric("bb_max_status_numeric", "max", status_number("status")),
            Metric("bb_recent_month", "max", "months_balance"),
            Metric("bb_oldest_month", "min", "months_balance"),
        ],
    )
    return counted.withColumns(
        dict(
            [
                _rate("bb_num_closed", "bb_total_snapshots", "bb_pct_closed", 1.0, r.share),
                _rate("bb_num_status_1_5", "bb_total_snapshots", "bb_pct_dpd", 1.0, r.share),
            ]
        )
    )


def balance_client_profile(snapshots: DataFrame, credits: DataFrame, labels: DataFrame, label: str = "target",
                           digits: int | None = 4) -> DataFrame:
    """Status counts, worst status and percentages per client with label."""
    s = F.col("status")
    counted = entity_aggregate(
        _client_months(snapshots, credits),
        KEY,
        [
            _weight("bb_total_snapshots"),
            Metric("bb_months_observed", "count_distinct", "months_balance"),
            *[_weight(f"bb_status_{v.lower()}_count", s == v) for v in ("0", *LATE_STATUSES, "C", "X")],
            Metric("bb_worst_status_numeric", "max", status_number("status")),
            _weight("bb_delinquency_months", s.isin(*LATE_STATUSES)),
            _weight("bb_severe_delinquency_months", s.isin(*SEVERE_STATUSES)),
        ],
    )
    rates = dict(
        [
            _rate("bb_delinquency_months", "bb_total_snapshots", "bb_pct_delinquency_months", 100.0, digits),
            _rate("bb_status_c_count", "bb_total_snapshots", "bb_pct_closed_months", 100.0, digits),
            _rate("bb_status_x_count", "bb_total_snapshots", "bb_pct_unknown_months", 100.0, digits),
        ]
    )
    return counted.withColumns(rates).join(labels.select(KEY, label), KEY, "inner")


def balance_per_credit(snapshots: DataFrame) -> DataFrame:
    """Months by status per credit, statuses taken literally."""
    s = F.col("status")
    return entity_aggregate(
        ensure_columns(snapshots, BALANCE_COLUMNS),
        "sk_id_bureau",
        [
            count("bb_num_months"),
            count("bb_status_0", s == "0"),
            count("bb_status_1", s == "1"),
            count("bb_late_months", s.isin("2", "3", "4", "5")),
            count("bb_closed_months", s == "C"),
            count("bb_unknown_months", s == "X"),
        ],
    )


# --- previous applications --------------------------------------------------

PREVIOUS_COLUMNS = {
    "sk_id_prev": "bigint", "sk_id_curr": "bigint", "name_contract_status": "string", "amt_application": "double",
    "amt_credit": "double", "amt_annuity": "double", "amt_goods_price": "double", "amt_down_payment": "double",
    "days_decision": "int", "cnt_payment": "double", "flag_last_appl_per_contract": "string",
    "nflag_last_appl_in_day": "int", "sellerplace_area": "int",
}


def previous_features(previous: DataFrame, r: Rounding = DEFAULT, tie: str = "sk_id_prev") -> DataFrame:
    """Counts by outcome, amounts and the last status (greatest decision day,
    ties by ``tie``). The status is aggregated apart: a maximum of structs makes
    Spark sort its input, and so only the four columns it needs are sorted, and
    the wide aggregate hashes. Both sides are dealt by client, so the join adds
    no shuffle."""
    df = ensure_columns(previous, PREVIOUS_COLUMNS).withColumn("_status", status("name_contract_status", "UNKNOWN"))
    s = F.col("_status")
    metrics = [
        count("prev_num_applications"),
        count("prev_approved_count", s == "APPROVED"),
        count("prev_refused_count", s == "REFUSED"),
        count("prev_canceled_count", s == "CANCELED"),
        count("prev_unused_offer_count", s == "UNUSED OFFER"),
        Metric("prev_avg_amt_application", "avg", "amt_application", digits=r.money),
        Metric("prev_avg_amt_credit", "avg", "amt_credit", digits=r.money),
        Metric("prev_avg_amt_annuity", "avg", "amt_annuity", digits=r.money),
        Metric("prev_total_amt_credit", "sum0", "amt_credit", digits=r.total),
        Metric("prev_avg_days_decision", "avg", "days_decision", digits=r.money),
        Metric("prev_min_days_decision", "min", "days_decision"),
        Metric("prev_credit_application_ratio", "avg", safe_ratio("amt_credit", "amt_application", "positive"), digits=r.share),
        Metric("prev_avg_cnt_payment", "avg", "cnt_payment", digits=r.money),
    ]
    last = F.max(F.struct(F.col("days_decision"), F.col(tie), F.col("_status")))["_status"].alias("prev_last_status")
    latest = df.select(KEY, "days_decision", tie, "_status").groupBy(KEY).agg(last)
    return df.groupBy(KEY).agg(*[m.column() for m in metrics]).join(latest, KEY, "left")


def previous_summary(previous: DataFrame, digits: int | None = 2) -> DataFrame:
    s = F.col("name_contract_status")
    return entity_aggregate(
        ensure_columns(previous, PREVIOUS_COLUMNS),
        KEY,
        [
            count("prev_num_applications"),
            count("prev_approved", s == "Approved"),
            count("prev_refused", s == "Refused"),
            Metric("prev_avg_amt_application", "avg", "amt_application", digits=digits),
            Metric("prev_avg_amt_credit", "avg", "amt_credit", digits=digits),
            Metric("prev_avg_down_payment", "avg", "amt_down_payment", digits=digits),
        ],
    )


def previous_numeric(previous: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Medians (sketches of bounded size), missing shares and flags."""
    df = ensure_columns(previous, PREVIOUS_COLUMNS)
    area = F.col("sellerplace_area")

    def median(name: str, value) -> Metric:
        return Metric(name, "quantile", value, accuracy=accuracy)

    metrics = [
        Metric("previous_count", "count", "sk_id_prev"),
        Metric("days_decision_max", "max", "days_decision"),
        *[
            median(f"{c}_median", c)
            for c in ("days_decision", "amt_application", "amt_credit", "amt_annuity", "amt_goods_price")
        ],
        Metric("amt_credit_sum", "sum", "amt_credit"),
        median("cnt_payment_median", "cnt_payment"),
        median("application_credit_ratio_median", safe_ratio("amt_application", "amt_credit", "positive")),
        median("annuity_credit_ratio_median", safe_ratio("amt_annuity", "amt_credit", "positive")),
        median("goods_credit_ratio_median", safe_ratio("amt_goods_price", "amt_credit", "positive")),
        *[
            Metric(f"{c}_missing_mean", "share", where=F.col(c).isNull())
            for c in ("amt_annuity", "amt_goods_price", "cnt_payment")
        ],
        Metric("last_appl_per_contract_mean", "avg", map_values("flag_last_appl_per_contract", {"Y": 1, "N": 0})),
        Metric("last_appl_in_day_mean", "avg", "nflag_last_appl_in_day"),
        Metric("sellerplace_area_nonpositive_mean", "share", where=F.coalesce(area, F.lit(0)) <= 0),
        median("sellerplace_area_positive_median", keep_if(area, area > 0)),
    ]
    return entity_aggregate(df, KEY, metrics)


PREVIOUS_CATEGORIES = ("name_client_type", "name_product_type", "channel_type")


def previous_model_features(previous: DataFrame, categories: Sequence[str] = PREVIOUS_CATEGORIES,
                            values: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Numeric block with the category shares of the columns that exist."""
    rows = require_keys(previous, [KEY, "sk_id_prev"])
    numeric = previous_numeric(rows)
    present = [c for c in categories if c in rows.columns]
    return attach(numeric, category_shares(rows, KEY, present, values), KEY) if present else numeric


# --- installments -----------------------------------------------------------

INSTALLMENT_COLUMNS = {
    "sk_id_prev": "bigint", "sk_id_curr": "bigint", "num_instalment_number": "int", "days_instalment": "double",
    "days_entry_payment": "double", "amt_instalment": "double", "amt_payment": "double",
}


def installment_features(installments: DataFrame, r: Rounding = DEFAULT) -> DataFrame:
    df = ensure_columns(installments, INSTALLMENT_COLUMNS)
    delay = F.col("days_entry_payment") - F.col("days_instalment")
    ratio = safe_ratio("amt_payment", "amt_instalment", "positive")
    late, under = delay > 0, ratio < 1
    return entity_aggregate(
        df,
        KEY,
        [
            count("inst_num_payments"),
            Metric("inst_avg_payment_delay", "avg", delay, digits=r.money),
            Metric("inst_max_payment_delay", "max", delay),
            count("inst_late_payment_count", late),
            share("inst_pct_late_payments", late, r),
            Metric("inst_avg_payment_ratio", "avg", ratio, digits=r.share),
            Metric("inst_min_payment_ratio", "min", ratio, digits=r.share),
            count("inst_underpayment_count", under),
            share("inst_pct_underpayment", under, r),
            Metric("inst_total_instalment", "sum0", "amt_instalment", digits=r.total),
            Metric("inst_total_payment", "sum0", "amt_payment", digits=r.total),
        ],
    )


def installment_summary(installments: DataFrame, digits: int | None = 2) -> DataFrame:
    df = ensure_columns(installments, INSTALLMENT_COLUMNS)
    delay = F.col("days_entry_payment") - F.col("days_instalment")
    return entity_aggregate(
        df,
        KEY,
        [
            count("inst_num_payments"),
            Metric("inst_avg_instalment", "avg", "amt_instalment", digits=digits),
            Metric("inst_avg_payment", "avg", "amt_payment", digits=digits),
            Metric("inst_avg_payment_diff", "avg", F.col("amt_payment") - F.col("amt_instalment"), digits=digits),
            count("inst_late_payments", delay > 0),
            Metric("inst_avg_days_delay", "avg", delay, digits=digits),
        ],
    )


def _behaviour_rows(installments: DataFrame, null_safe: bool) -> DataFrame:
    """Days past due and capped payment ratio per payment. Without
    ``null_safe`` a missing payment counts as 0 days past due and as ratio 3,
    which is what null-skipping ``greatest`` and ``least`` give."""
    df = require_keys(ensure_columns(installments, INSTALLMENT_COLUMNS), [KEY, "sk_id_prev"])
    due = F.col("amt_instalment")
    ratio = clip(safe_ratio("amt_payment", "amt_instalment"), hi=3.0, null_safe=null_safe)
    return df.withColumns(
        {
            "_dpd": positive_part(F.col("days_entry_payment") - F.col("days_instalment"), null_safe),
            "_ratio": F.when(due.isNotNull() & (due != 0), ratio),
        }
    )


def installment_behaviour(installments: DataFrame, null_safe: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Payment behaviour with median days past due and payment ratio; the
    medians are sketches of bounded size.

    Distinct loans are counted in a branch of their own over two columns: next
    to a distinct count Spark would build the sketches per (client, loan).
    """
    rows = _behaviour_rows(installments, null_safe)
    dpd = F.col("_dpd")
    behaviour = entity_aggregate(
        rows,
        KEY,
        [
            Metric("installments_count", "count", "num_instalment_number"),
            Metric("dpd_median", "quantile", dpd, accuracy=accuracy),
            Metric("dpd_max", "max", dpd),
            Metric("late_payment_mean", "share", where=dpd > 0),
            count("late_30_sum", dpd > 30),
            Metric("amt_instalment_sum", "sum", "amt_instalment"),
            Metric("amt_payment_sum", "sum", "amt_payment"),
            Metric("payment_ratio_median", "quantile", "_ratio", accuracy=accuracy),
            Metric("underpaid_mean", "share", where=F.col("amt_payment") < F.col("amt_instalment")),
            Metric("missed_payment_mean", "share", where=F.coalesce("amt_payment", F.lit(0.0)) == 0),
        ],
    )
    loans = entity_aggregate(rows.select(KEY, "sk_id_prev").distinct(), KEY, [count("previous_loans_nunique")])
    return attach(behaviour, loans, KEY)


# --- POS and card months ----------------------------------------------------

POS_COLUMNS = {
    "sk_id_curr": "bigint", "sk_id_prev": "bigint", "months_balance": "int", "sk_dpd": "int", "sk_dpd_def": "int",
    "name_contract_status": "string", "cnt_instalment": "double", "cnt_instalment_future": "double",
}


def pos_features(pos: DataFrame, r: Rounding = DEFAULT) -> DataFrame:
    s = status("name_contract_status", "UNKNOWN")
    return entity_aggregate(
        ensure_columns(pos, POS_COLUMNS),
        KEY,
        [
            count("pos_num_records"),
            Metric("pos_avg_months_balance", "avg", "months_balance", digits=r.money),
            Metric("pos_max_sk_dpd", "max", "sk_dpd"),
            Metric("pos_avg_sk_dpd", "avg", "sk_dpd", digits=r.money),
            Metric("pos_max_sk_dpd_def", "max", "sk_dpd_def"),
            Metric("pos_avg_sk_dpd_def", "avg", "sk_dpd_def", digits=r.money),
            count("pos_completed_count", s == "COMPLETED"),
            count("pos_active_count", s == "ACTIVE"),
            share("pos_pct_completed", s == "COMPLETED", r),
            Metric("pos_avg_cnt_instalment", "avg", "cnt_instalment", digits=r.money),
            Metric("pos_avg_cnt_instalment_future", "avg", "cnt_instalment_future", digits=r.money),
        ],
    )


def pos_summary(pos: DataFrame, digits: int | None = 2) -> DataFrame:
    return entity_aggregate(
        ensure_columns(pos, POS_COLUMNS),
        KEY,
        [
            count("pos_num_records"),
            Metric("pos_max_dpd", "max", "sk_dpd"),
            Metric("pos_avg_dpd", "avg", "sk_dpd", digits=digits),
            Metric("pos_max_dpd_def", "max", "sk_dpd_def"),
            Metric("pos_avg_installments_future", "avg", "cnt_instalment_future", digits=digits),
        ],
    )


def pos_client_profile(pos: DataFrame, labels: DataFrame, label: str = "target", digits: int | None = 2) -> DataFrame:
    """Arrears per client with label and the most frequent status (ties to the
    lowest), aggregated before the label join."""
    profile = entity_aggregate(
        ensure_columns(pos, POS_COLUMNS),
        KEY,
        [
            count("total_snapshots"),
            Metric("pos_credits", "count_distinct", "sk_id_prev"),
            count("months_in_arrears", F.col("sk_dpd") > 0),
            Metric("max_dpd", "max", "sk_dpd"),
            Metric("avg_dpd", "avg", "sk_dpd", digits=digits),
            Metric("max_term", "max", "cnt_instalment"),
            Metric("frequent_status", "mode", "name_contract_status"),
        ],
    )
    return profile.join(valid_label(labels, label).select(KEY, label), KEY, "inner")


CARD_COLUMNS = {
    "sk_id_curr": "bigint", "sk_id_prev": "bigint", "months_balance": "int", "amt_balance": "double",
    "amt_credit_limit_actual": "int", "amt_drawings_current": "double", "amt_payment_total_current": "double",
    "amt_payment_current": "double", "amt_inst_min_regularity": "double", "cnt_drawings_current": "int",
    "sk_dpd": "int", "sk_dpd_def": "int", "name_contract_status": "string", "amt_drawings_atm_current": "double",
    "amt_drawings_pos_current": "double", "amt_drawings_other_current": "double",
}


def utilisation() -> Column:
    return safe_ratio("amt_balance", "amt_credit_limit_actual", "positive")


def below_minimum() -> Column:
    return F.col("amt_payment_current") < F.col("amt_inst_min_regularity")


def card_features(card: DataFrame, r: Rounding = DEFAULT) -> DataFrame:
    limit = F.col("amt_credit_limit_actual")
    return entity_aggregate(
        ensure_columns(card, CARD_COLUMNS),
        KEY,
        [
            count("cc_num_records"),
            Metric("cc_avg_balance", "avg", "amt_balance", digits=r.money),
            Metric("cc_max_balance", "max", "amt_balance", digits=r.money),
            Metric("cc_avg_credit_limit", "avg", "amt_credit_limit_actual", digits=r.money),
            Metric("cc_max_credit_limit", "max", "amt_credit_limit_actual"),
            Metric("cc_avg_drawings", "avg", "amt_drawings_current", digits=r.money),
            Metric("cc_total_drawings", "sum0", "amt_drawings_current", digits=r.total),
            Metric("cc_avg_payment_total", "avg", "amt_payment_total_current", digits=r.money),
            Metric("cc_total_payment", "sum0", "amt_payment_total_current", digits=r.total),
            Metric("cc_max_dpd", "max", "sk_dpd"),
            Metric("cc_avg_dpd", "avg", "sk_dpd", digits=r.money),
            Metric("cc_max_dpd_def", "max", "sk_dpd_def"),
            Metric("cc_avg_dpd_def", "avg", "sk_dpd_def", digits=r.money),
            Metric("cc_avg_cnt_drawings", "avg", "cnt_drawings_current", digits=r.money),
            Metric("cc_utilization_ratio", "avg", utilisation(), digits=r.share),
            count("cc_missing_limit_count", limit.isNull() | (limit <= 0)),
        ],
    )


def card_summary(card: DataFrame, digits: int | None = 2) -> DataFrame:
    return entity_aggregate(
        ensure_columns(card, CARD_COLUMNS),
        KEY,
        [
            count("cc_num_records"),
            Metric("cc_avg_balance", "avg", "amt_balance", digits=digits),
            Metric("cc_max_balance", "max", "amt_balance", digits=digits),
            Metric("cc_avg_limit", "avg", "amt_credit_limit_actual", digits=digits),
            Metric("cc_max_dpd", "max", "sk_dpd"),
            Metric("cc_max_dpd_def", "max", "sk_dpd_def"),
        ],
    )


def card_client_profile(card: DataFrame, labels: DataFrame, label: str = "target", digits: int | None = 2,
                        percent: int | None = 2) -> DataFrame:
    """Balance, utilisation and arrears per client with label; ``digits`` of
    amounts, ``percent`` of percentages."""
    profile = entity_aggregate(
        ensure_columns(card, CARD_COLUMNS),
        KEY,
        [
            count("total_snapshots"),
            Metric("cards", "count_distinct", "sk_id_prev"),
            Metric("avg_balance", "avg", "amt_balance", digits=digits),
            Metric("max_balance", "max", "amt_balance", digits=digits),
            Metric("utilisation_pct", "avg", utilisation() * F.lit(100.0), digits=percent),
            count("months_in_arrears", F.col("sk_dpd") > 0),
            Metric("max_dpd", "max", "sk_dpd"),
            Metric("pct_below_minimum", "pct", where=below_minimum(), digits=percent),
        ],
    )
    return profile.join(valid_label(labels, label).select(KEY, label), KEY, "inner")
