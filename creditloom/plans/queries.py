"""Named queries over the test tables: (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.quantiles import entity_quantiles, exact_quantiles
from creditloom.functions.rowexpr import (
    bucketize, clip, days_to_years, keep_if, log_amount, map_values, positive_part, positive_probability,
    row_count_flags, row_stats, row_sum, safe_ratio, status_number,
)
from creditloom.operators import cleaning, encoding, entity, joins, modeling, profiling, shaping
from creditloom.operators.entity import Metric
from creditloom.plans import blocks, master, reports
from creditloom.plans.blocks import KEY, Rounding
from creditloom.plans.fixtures import rule_predictions, view

Query = Callable[[SparkSession, str], DataFrame]

# Averages and shares unrounded, sums at 6 decimals: decimal ties are rounded
# differently by different engines.
FINE = Rounding(money=None, share=None, total=6)

# Sketch accuracy for one value per column: exact up to some hundred thousand
# rows, a bounded rank error beyond.
FINE_SKETCH = 100_000

QUERIES: dict[str, Query] = {}


def query(*views: str):
    """Register a function of the named views under its own name."""

    def wrap(f: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[view(spark, sf_dir, v) for v in views])

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        return f

    return wrap


def satellites(bureau, balance, previous, installments, monthly) -> dict[str, DataFrame]:
    return {
        "bureau": bureau, "bureau_balance": balance, "previous_application": previous,
        "installments_payments": installments, "pos_cash_balance": monthly, "credit_card_balance": monthly,
    }


ALL_VIEWS = ("fx_application", "fx_bureau", "fx_bureau_balance", "fx_previous", "fx_installments", "fx_monthly")
AMOUNT_COLUMNS = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"]
BUREAU_AMOUNTS = ["amt_credit_sum", "amt_credit_sum_debt", "amt_credit_sum_limit", "amt_credit_sum_overdue"]
CATEGORY_COLUMNS = ["code_gender", "name_contract_type", "name_education_type", "organization_type", "flag_own_car"]
CORR_COLUMNS = [
    *AMOUNT_COLUMNS, "days_birth", "days_employed", "days_registration", "cnt_children", "cnt_fam_members",
    "ext_source_1", "ext_source_2", "ext_source_3",
]


# --- masters ----------------------------------------------------------------


@query(*ALL_VIEWS)
def client_master(application, *rest):
    """Cleaned application with all six blocks."""
    return master.client_master(application, satellites(*rest), FINE, accuracy=FINE_SKETCH)


@query(*ALL_VIEWS)
def master_validation(application, *rest):
    """Checks of the assembled master against its base."""
    whole = master.client_master(application, satellites(*rest), FINE)
    return profiling.validate_master(
        whole, application, KEY, ["age_years", "credit_income_ratio", "bureau_num_records", "pos_num_records"]
    )


@query(*ALL_VIEWS)
def analytic_master(application, *rest):
    """First version of the master."""
    return master.analytic_master(application, satellites(*rest), None, 6)


@query("fx_application", "fx_monthly")
def master_missing_source(application, monthly):
    """Absent satellites give typed null columns."""
    tables = {"pos_cash_balance": monthly}
    return master.client_master(application, tables, FINE, accuracy=FINE_SKETCH).select(
        KEY, "age_years", "pos_num_records", "bureau_num_records", "prev_last_status", "inst_avg_payment_ratio",
        "cc_avg_balance", "bb_total_snapshots",
    )


@query("fx_application")
def application_base(application):
    """A.1: cleaned application table with medians and flags."""
    return master.application_base(application, accuracy=FINE_SKETCH)


# --- entity blocks ----------------------------------------------------------


@query("fx_bureau")
def entity_block_bureau(bureau):
    return blocks.bureau_features(bureau, FINE)


@query("fx_bureau")
def entity_block_bureau_summary(bureau):
    return blocks.bureau_summary(bureau, None, 6)


@query("fx_bureau", "fx_application")
def entity_block_bureau_profile(bureau, application):
    return blocks.bureau_client_profile(bureau, application, money=6, years=6, ratio=6)


@query("fx_bureau_balance", "fx_bureau")
def entity_block_balance(balance, bureau):
    return blocks.balance_features(balance, bureau, FINE)


@query("fx_bureau_balance", "fx_bureau", "fx_application")
def entity_block_balance_profile(balance, bureau, application):
    return blocks.balance_client_profile(balance, bureau, application, digits=None)


@query("fx_bureau_balance")
def entity_block_balance_per_credit(balance):
    return blocks.balance_per_credit(balance)


@query("fx_previous")
def entity_block_previous_last(previous):
    return blocks.previous_features(previous, FINE)


@query("fx_previous")
def entity_block_previous_summary(previous):
    return blocks.previous_summary(previous, None)


@query("fx_previous")
def entity_block_previous_numeric(previous):
    return _rounded(blocks.previous_numeric(previous), ["amt_credit_sum"], 6)


@query("fx_installments")
def entity_block_installments(installments):
    return blocks.installment_features(installments, FINE)


@query("fx_installments")
def entity_block_installments_summary(installments):
    return blocks.installment_summary(installments, None)


@query("fx_installments")
def entity_block_behaviour(installments):
    return _rounded(blocks.installment_behaviour(installments), ["amt_instalment_sum", "amt_payment_sum"], 6)


@query("fx_installments")
def entity_block_behaviour_null_safe(installments):
    """Missing payments stay null."""
    out = blocks.installment_behaviour(installments, null_safe=True)
    return out.select(KEY, "dpd_median", "dpd_max", "payment_ratio_median")


@query("fx_monthly")
def entity_block_pos(monthly):
    return blocks.pos_features(monthly, FINE)


@query("fx_monthly")
def entity_block_pos_summary(monthly):
    return blocks.pos_summary(monthly, None)


@query("fx_monthly", "fx_application")
def entity_block_pos_profile(monthly, application):
    return blocks.pos_client_profile(monthly, application, digits=None)


@query("fx_monthly")
def entity_block_card(monthly):
    return blocks.card_features(monthly, FINE)


@query("fx_monthly")
def entity_block_card_summary(monthly):
    return blocks.card_summary(monthly, None)


@query("fx_monthly", "fx_application")
def entity_block_card_profile(monthly, application):
    return blocks.card_client_profile(monthly, application, digits=8, percent=6)


@query("fx_previous")
def category_shares(previous):
    """Value shares of two category columns per client."""
    return encoding.category_shares(previous, KEY, ["name_contract_status", "name_client_type"])


@query("fx_previous")
def long_shares(previous):
    """G9 in long form, for a column of very many values."""
    rows = previous.withColumn("decided", F.col("days_decision").cast("string"))
    return _rounded(encoding.long_shares(rows, "name_contract_status", ["decided", "name_client_type"]), ["share"], 9)


@query("fx_previous")
def metric_kinds(previous):
    """Every kind of metric in one declarative aggregation."""
    amount = F.col("amt_application")
    return entity.entity_aggregate(
        previous,
        KEY,
        [
            Metric("n", "count"),
            Metric("n_amount", "count", "amt_annuity"),
            Metric("n_large", "count", where=amount > 200000.0),
            Metric("total", "sum", "amt_application", digits=4),
            Metric("total_approved", "sum", "amt_application", where=F.col("name_contract_status") == "Approved", digits=4),
            Metric("total_null_safe", "sum0", "amt_annuity", digits=4),
            Metric("average", "avg", "days_decision"),
            Metric("average_refused", "avg", "days_decision", where=F.col("name_contract_status") == "Refused"),
            Metric("lowest", "min", "amt_application"),
            Metric("highest", "max", "amt_application"),
            Metric("highest_canceled", "max", "amt_application", where=F.col("name_contract_status") == "Canceled"),
            Metric("statuses", "count_distinct", "name_contract_status"),
            Metric("share_large", "share", where=amount > 200000.0),
            Metric("pct_large", "pct", where=amount > 200000.0),
            Metric("has_unused", "any", where=F.col("name_contract_status") == "Unused offer"),
            Metric("first_status", "first", "name_contract_status", order="sk_id_prev"),
            Metric("usual_client_type", "mode", "name_client_type"),
            Metric("median_decision", "quantile", "days_decision"),
        ],
    )


# --- quantiles --------------------------------------------------------------


@query("fx_bureau")
def exact_quantiles_global(bureau):
    """Exact discrete quantiles of whole columns, bounded per task."""
    return exact_quantiles(bureau, BUREAU_AMOUNTS, [0.25, 0.5, 0.9, 0.99])


@query("fx_installments")
def exact_quantiles_grouped(installments):
    """Exact interpolated quantiles per instalment number."""
    out = exact_quantiles(installments, ["amt_payment"], [0.1, 0.5], ["num_instalment_number"], kind="cont")
    return out.withColumn("value", F.round("value", 4))


@query("fx_installments")
def exact_client_medians(installments):
    """Exact interpolated medians per client."""
    rows = installments.withColumn("delay", F.col("days_entry_payment") - F.col("days_instalment"))
    return entity_quantiles(rows, KEY, {"delay_median": "delay"})


# --- profiling --------------------------------------------------------------


@query("fx_application")
def null_profile(application):
    return profiling.null_profile(application, digits=None)


@query("fx_application")
def numeric_summary(application):
    out = profiling.numeric_summary(application, [*AMOUNT_COLUMNS, "days_birth", "days_employed"], method="exact")
    return _rounded(out, ["mean"], 6)


@query("fx_bureau")
def amount_summary(bureau):
    """J4 on credit amounts: mean, median, p90, maximum and nulls."""
    out = profiling.numeric_summary(bureau, BUREAU_AMOUNTS, {"median": 0.5, "p90": 0.9}, method="exact")
    return _rounded(out, ["mean"], 6)


@query("fx_application")
def iqr_outliers(application):
    return profiling.iqr_outliers(application, AMOUNT_COLUMNS, method="exact")


@query("fx_application")
def histogram(application):
    return _rounded(profiling.histogram(application, "amt_income_total", 50), ["lower", "upper"], 6)


@query("fx_application")
def quick_profile(application):
    return profiling.quick_profile(application, exact=True, digits=None).select(
        "column", "nulls", "distinct_values", "pct_nulls", "role"
    )


@query("fx_application")
def top_missing(application):
    return profiling.top_missing(profiling.quick_profile(application, digits=None), 5).select("column", "nulls")


@query("fx_bureau")
def rule_violations(bureau):
    return profiling.rule_violations(bureau, reports.bureau_rules(), KEY)


@query(*ALL_VIEWS)
def table_inventory(*tables):
    return profiling.table_inventory(dict(zip(ALL_VIEWS, tables)))


@query(*ALL_VIEWS)
def quality_resume(*tables):
    return profiling.quality_resume(dict(zip(ALL_VIEWS, tables)))


@query("fx_application")
def label_distribution(application):
    return profiling.label_distribution(application)


@query("fx_application")
def category_rate(application):
    return profiling.category_rate(application, CATEGORY_COLUMNS)


@query("fx_application")
def business_kpis(application):
    features = application.withColumns(row_stats(master.EXTERNAL_SCORES, "ext_sources"))
    out = profiling.business_kpis(features).drop("columns")
    return _rounded(out, ["mean_amount", "mean_external_score"], 6)


@query("fx_application")
def distribution_summary(application):
    out = profiling.distribution_summary(application, AMOUNT_COLUMNS, "target", FINE_SKETCH)
    return _rounded(out, ["mean"], 6)


@query("fx_previous")
def duplicate_keys(previous):
    """(client, day) pairs with more than one application."""
    return entity.duplicates(previous, [KEY, "days_decision"])


@query("fx_application")
def corr_ranking(application):
    return reports.correlation_ranking(application, CORR_COLUMNS)


@query("fx_application")
def score_summary(application):
    return _rounded(reports.score_summary(application), ["mean", "corr_target"], 6)


# --- reports ----------------------------------------------------------------


@query("fx_monthly")
def overview(monthly):
    """Rows, distinct clients and contracts, snapshots per contract."""
    return profiling.overview(
        monthly, {"clients": KEY, "contracts": "sk_id_prev"}, {"month": "months_balance"}, {"rows_per_contract": "contracts"}
    )


@query("fx_bureau")
def overview_bureau(bureau):
    return profiling.overview(
        bureau,
        {"clients": KEY, "credits": "sk_id_bureau", "credit_types": "credit_type", "credit_states": "credit_active"},
        {"days_credit": "days_credit"},
        {"rows_per_client": "clients"},
    )


@query("fx_monthly")
def status_distribution(monthly):
    return reports.status_distribution(monthly, "name_contract_status")


@query("fx_bureau")
def credit_state_distribution(bureau):
    return reports.credit_state_distribution(bureau)


@query("fx_bureau")
def credit_type_distribution(bureau):
    return reports.credit_type_distribution(bureau)


@query("fx_bureau_balance")
def balance_status_distribution(balance):
    return reports.balance_status_distribution(balance)


@query("fx_previous")
def previous_status_distribution(previous):
    return reports.status_distribution(previous, "name_contract_status", distinct=KEY)


@query("fx_monthly")
def arrears_statistics(monthly):
    return _rounded(reports.arrears_statistics(monthly, method="exact"), ["mean"], 6)


@query("fx_monthly")
def bucket_distribution(monthly):
    return reports.bucket_distribution(monthly, F.col("sk_dpd"), reports.DPD)


@query("fx_bureau")
def amount_buckets(bureau):
    return reports.bucket_distribution(bureau, F.col("amt_credit_sum"), reports.AMOUNT)


@query("fx_bureau")
def overdue_distribution(bureau):
    return _rounded(reports.overdue_distribution(bureau), ["avg_amt_overdue"], 6)


@query("fx_monthly")
def utilisation_distribution(monthly):
    return reports.utilisation_distribution(monthly)


@query("fx_monthly", "fx_application")
def bucket_by_label(monthly, application):
    """Clients by worst arrears bucket and label."""
    return reports.bucket_by_label(blocks.pos_client_profile(monthly, application), "max_dpd", reports.DPD)


@query("fx_monthly", "fx_application")
def utilisation_by_label(monthly, application):
    profile = blocks.card_client_profile(monthly, application, digits=None, percent=None)
    return reports.bucket_by_label(profile, "utilisation_pct", reports.UTILISATION_PCT)


@query("fx_monthly")
def card_balance_statistics(monthly):
    out = reports.balance_statistics(monthly).drop("median_balance", "p90_balance")
    return _rounded(out, ["avg_balance", "avg_limit", "avg_utilisation_pct"], 6)


@query("fx_monthly")
def term_top20(monthly):
    return reports.term_distribution(monthly)


@query("fx_monthly")
def progress_summary(monthly):
    return reports.progress_summary(monthly, 6)


@query("fx_monthly")
def month_trend(monthly):
    return reports.pos_trend(monthly)


@query("fx_monthly")
def card_trend(monthly):
    return reports.card_trend(monthly, 6)


@query("fx_bureau_balance")
def balance_trend(balance):
    return reports.balance_trend(balance)


@query("fx_monthly", "fx_application")
def pos_label_summary(monthly, application):
    """Client arrears averaged per label."""
    profile = blocks.pos_client_profile(monthly, application, digits=None)
    names = ["total_snapshots", "pos_credits", "months_in_arrears", "max_dpd", "avg_dpd"]
    return reports.label_summary(profile, {f"avg_{n}": n for n in names}, digits=6)


@query("fx_monthly", "fx_application")
def card_label_summary(monthly, application):
    profile = blocks.card_client_profile(monthly, application, digits=None, percent=None)
    names = ["cards", "avg_balance", "utilisation_pct", "months_in_arrears", "max_dpd", "pct_below_minimum"]
    return reports.label_summary(profile, {f"mean_{n}": n for n in names}, digits=6)


@query("fx_bureau", "fx_application")
def bureau_label_summary(bureau, application):
    profile = blocks.bureau_client_profile(bureau, application, money=None, years=None, ratio=None)
    names = [
        "bureau_credit_count", "bureau_total_credit_sum", "bureau_total_debt_sum", "bureau_total_overdue_sum",
        "bureau_overdue_credit_count", "bureau_max_credit_day_overdue", "bureau_debt_ratio_mean", "bureau_debt_ratio_max",
        "bureau_avg_credit_age_years", "bureau_oldest_update_days",
    ]
    return reports.label_summary(
        profile,
        {f"avg_{n}": n for n in names},
        digits=5,
        quantiles={"med_bureau_credit_count": ("bureau_credit_count", 0.5), "p90_bureau_credit_count": ("bureau_credit_count", 0.9)},
        exact=True,
    )


@query("fx_bureau", "fx_application")
def bureau_labelled_summary(bureau, application):
    """Averages over all labelled clients, those without credits included."""
    per_client = entity.entity_aggregate(
        bureau,
        KEY,
        [
            Metric("records", "count"),
            Metric("total_debt", "sum", "amt_credit_sum_debt"),
            Metric("active_credits", "count", where=F.col("credit_active") == "Active"),
        ],
    )
    return reports.labelled_summary(application, per_client, {f"avg_{n}": n for n in ("records", "total_debt", "active_credits")}, 6)


@query("fx_bureau_balance", "fx_bureau", "fx_application")
def balance_label_summary(balance, bureau, application):
    profile = blocks.balance_client_profile(balance, bureau, application, digits=None)
    names = [
        "bb_total_snapshots", "bb_worst_status_numeric", "bb_delinquency_months", "bb_severe_delinquency_months",
        "bb_pct_delinquency_months", "bb_pct_unknown_months", "bb_pct_closed_months",
    ]
    return reports.label_summary(
        profile,
        {f"avg_{n}": n for n in names},
        digits=6,
        quantiles={
            "med_bb_total_snapshots": ("bb_total_snapshots", 0.5),
            "p90_bb_worst_status_numeric": ("bb_worst_status_numeric", 0.9),
        },
        exact=True,
    )


@query("fx_application", "fx_previous")
def previous_label_summary(application, previous):
    aggregate = blocks.previous_summary(previous, None)
    names = ["prev_num_applications", "prev_approved", "prev_refused"]
    return reports.labelled_summary(application, aggregate, {f"avg_{n}": n for n in names}, 6)


@query(*ALL_VIEWS)
def label_summary(application, *rest):
    """E8 on the first master."""
    whole = master.analytic_master(application, satellites(*rest), None, None)
    names = [
        "age_years", "credit_income_ratio", "annuity_income_ratio", "bureau_num_records", "prev_num_applications",
        "inst_late_payments",
    ]
    return reports.label_summary(whole, {f"avg_{n}": n for n in names}, digits=6)


@query("fx_monthly", "fx_application")
def last_status_by_label(monthly, application):
    return reports.last_status_by_label(monthly, application)


@query("fx_monthly", "fx_application")
def last_status_pivot(monthly, application):
    """Contracts by last status with label columns and rate."""
    counts = reports.last_status_by_label(monthly, application)
    return shaping.pivot_rate(counts, "name_contract_status", "target", F.col("contracts"))


@query("fx_monthly")
def latest_snapshot(monthly):
    """Latest snapshot per client and contract."""
    return shaping.latest_per(
        monthly, [KEY, "sk_id_prev"], "months_balance", "event_id", ["months_balance", "event_id", "name_contract_status", "amt_balance"]
    )


@query("fx_monthly")
def payments_summary(monthly):
    return _rounded(reports.payments_summary(monthly), ["avg_drawings", "avg_atm", "avg_pos", "avg_other", "avg_payment", "avg_minimum"], 6)


@query("fx_monthly")
def amount_mix(monthly):
    return reports.amount_mix(monthly, digits=4)


@query("fx_monthly")
def arrears_by_status(monthly):
    """E13 on card months."""
    extra = [Metric("avg_dpd", "avg", "sk_dpd", digits=6), Metric("max_dpd", "max", "sk_dpd")]
    return reports.arrears_by(monthly, {"name_contract_status": F.col("name_contract_status")}, F.col("sk_dpd"), extra=extra)


@query("fx_bureau")
def overdue_global(bureau):
    return reports.overdue_global(bureau, 6)


@query("fx_bureau")
def overdue_by_type(bureau):
    return _rounded(reports.overdue_by_type(bureau), ["avg_days_overdue"], 6)


@query("fx_bureau")
def overdue_by_state(bureau):
    days = F.coalesce("credit_day_overdue", F.lit(0))
    return reports.arrears_by(bureau, {"credit_active": cleaning.category("credit_active")}, days)


@query("fx_application", "fx_previous", "fx_monthly")
def coverage_by_label(application, previous, monthly):
    """Clients by the histories they have."""
    return reports.coverage_by_label(application, {"previous": previous, "monthly": monthly})


@query("fx_bureau", "fx_application")
def temporal_summary(bureau, application):
    return reports.temporal_summary(bureau, application, 6)


@query("fx_bureau", "fx_bureau_balance", "fx_application")
def combined_frame(bureau, balance, application):
    """Both bureau sources per client and label."""
    return reports.combined_frame(
        blocks.bureau_client_profile(bureau, application, money=6, years=6, ratio=6),
        blocks.balance_client_profile(balance, bureau, application, digits=None),
    )


@query("fx_bureau", "fx_bureau_balance", "fx_application")
def severity_rate(bureau, balance, application):
    return reports.severity_rate(
        reports.combined_frame(
            blocks.bureau_client_profile(bureau, application), blocks.balance_client_profile(balance, bureau, application)
        )
    )


@query("fx_application")
def age_income_by_label(application):
    return reports.age_income_by_label(application, 6, exact=True)


@query("fx_bureau")
def financial_ratios(bureau):
    out = reports.financial_ratios(bureau, method="exact")
    return _rounded(out, ["mean", "min", "max", "median", "p90"], 6)


@query("fx_application")
def findings_nulls(application):
    """The ten columns with most nulls."""
    return profiling.null_profile(application, 10, None)


@query("fx_application")
def findings_correlation(application):
    return reports.correlation_ranking(application, CORR_COLUMNS).limit(10)


# --- cleaning and row features ---------------------------------------------


@query("fx_application")
def clean_table(application):
    """Sentinels, sparse columns, sparse rows."""
    return cleaning.clean_table(application, cleaning.CleanConfig((KEY, "target")))


@query("fx_application")
def null_sentinel(application):
    """Sentinel to null with its flag taken in the same step."""
    out = cleaning.null_sentinel(application, flag_suffix="_was_sentinel")
    return out.select(KEY, "days_employed", "days_employed_was_sentinel")


@query("fx_application")
def null_anomaly(application):
    out = cleaning.null_anomaly(application, master.day_rules())
    return out.select(
        KEY, *[c for d in ("days_birth", "days_employed", "days_registration") for c in (d, f"{d}_anom_flag", master.DAY_YEARS[d])]
    )


@query("fx_application")
def missing_flags(application):
    flags = [c for c in master.MISSING_FLAGS if c in application.columns]
    return cleaning.missing_flags(application, flags).select(KEY, *[f"{c}_missing_flag" for c in flags])


@query("fx_application")
def fill_strings(application):
    return cleaning.fill_strings(application).select(KEY, "name_education_type", "code_gender")


@query("fx_application")
def normalize_category(application):
    return cleaning.normalize_category(application, "code_gender", {"xna": "Unknown"}).select(KEY, "code_gender")


@query("fx_application")
def median_impute(application):
    """Medians learned on the training split only."""
    train, _ = encoding.hash_split(application, KEY, 0.8, method="md5")
    model = cleaning.fit_median(train, AMOUNT_COLUMNS, "exact")
    return cleaning.apply_fill(application, model, flags=True).select(
        KEY, *AMOUNT_COLUMNS, *[f"flag_missing_{c}" for c in AMOUNT_COLUMNS]
    )


@query("fx_application")
def constant_impute(application):
    return cleaning.fill_numeric(application, 0, ["ext_source_1", "mostly_null"]).select(KEY, "ext_source_1", "mostly_null")


@query("fx_application")
def drop_constant(application):
    return cleaning.drop_constant_columns(application)


@query("fx_application")
def drop_sparse(application):
    return cleaning.drop_sparse_columns(application, 0.4, [KEY])


@query("fx_application")
def drop_sparse_rows(application):
    """C11 at a threshold some rows reach."""
    cols = [KEY, "amt_annuity", "amt_goods_price", "cnt_fam_members", "ext_source_1", "ext_source_2", "ext_source_3"]
    return cleaning.drop_sparse_rows(application.select(*cols), 0.3)


@query("fx_application")
def drop_document_flags(application):
    return cleaning.drop_prefix(application, "flag_document_").select(*[c for c in application.columns if c.startswith(("sk_", "flag_")) and "document" not in c])


@query("fx_monthly")
def row_predicates(monthly):
    """Required keys, ranges, membership and column comparison."""
    rows = cleaning.require_keys(monthly, [KEY, "sk_id_prev"])
    return rows.filter(
        F.col("sk_dpd").between(1, 90)
        & F.col("months_balance").isin(-1, -2, -3, -10)
        & F.col("amt_payment_current").isNotNull()
        & (F.col("amt_payment_current") < F.col("amt_balance"))
    ).select("event_id", KEY, "sk_dpd", "months_balance")


@query("fx_application")
def safe_ratios(application):
    """Guarded and smoothed ratios."""
    smooth = master.smoothed_ratios([*application.columns])
    return application.select(
        KEY,
        safe_ratio("amt_goods_price", "amt_credit").alias("goods_credit"),
        safe_ratio("amt_goods_price", "amt_credit", "positive").alias("goods_credit_positive"),
        *[e.alias(n) for n, e in smooth.items()],
    )


@query("fx_installments")
def payment_rows(installments):
    """Delay, days past due, capped ratio and flags, both null rules."""
    delay = F.col("days_entry_payment") - F.col("days_instalment")
    ratio = safe_ratio("amt_payment", "amt_instalment")
    return installments.select(
        "sk_id_prev",
        "num_instalment_number",
        delay.alias("delay"),
        positive_part(delay).alias("dpd"),
        positive_part(delay, null_safe=True).alias("dpd_null_safe"),
        F.round(clip(ratio, hi=3.0), 9).alias("ratio_capped"),
        F.round(clip(ratio, hi=1.0, null_safe=True), 9).alias("ratio_null_safe"),
        F.when(delay > 30, 1).otherwise(0).alias("late_30"),
    )


@query("fx_previous")
def value_maps(previous):
    """Conditional null and value maps."""
    area = F.col("sellerplace_area")
    return previous.select(
        "sk_id_prev",
        keep_if(area, area > 0).alias("area_positive"),
        map_values("flag_last_appl_per_contract", {"Y": 1, "N": 0}).alias("last_flag"),
    )


@query("fx_bureau_balance")
def status_numbers(balance):
    """Numeric level of each status, counted."""
    level = status_number(blocks.status("status", "X"))
    return balance.groupBy(blocks.status("status", "X").alias("status"), level.alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("fx_application")
def row_stats_query(application):
    return _rounded(
        application.select(KEY, *[e.alias(n) for n, e in row_stats(master.EXTERNAL_SCORES, "ext_sources").items()]),
        ["ext_sources_mean", "ext_sources_std"],
        6,
    )


@query("fx_application")
def row_sums(application):
    return application.select(
        KEY,
        row_sum(["amt_req_credit_bureau_mon", "amt_req_credit_bureau_year"]).alias("requests"),
        row_sum(["obs_30_cnt_social_circle", "def_30_cnt_social_circle"]).alias("social"),
    )


@query("fx_application")
def row_count_flags_query(application):
    return application.select(
        KEY,
        row_count_flags(["flag_phone", "flag_email"]).alias("contacts"),
        row_count_flags(["reg_city_not_live_city", "reg_city_not_work_city"]).alias("mismatches"),
        row_count_flags(["flag_document_2", "flag_document_3", "cnt_children"]).alias("documents"),
    )


@query("fx_application")
def years_and_buckets(application):
    """Day offsets to years, bucket labels with explicit rank."""
    label = bucketize("amt_income_total", (50_000, 100_000, 150_000), ("low", "mid", "high", "top"), "none")
    return application.select(KEY, days_to_years("days_birth").alias("age_years"), label.alias("income_class"))


@query("fx_application")
def learned_caps(application):
    """Amounts capped at a learned quantile, and their logs."""
    caps = encoding.fit_caps(application, {c: 0.9 for c in AMOUNT_COLUMNS}, "exact")
    out = encoding.apply_caps(application, caps)
    return out.select(KEY, *[f"{c}_cap" for c in AMOUNT_COLUMNS], *[F.round(log_amount(f"{c}_cap"), 6).alias(f"{c}_log") for c in AMOUNT_COLUMNS])


@query("fx_application")
def application_features(application):
    """The wide application block."""
    out = master.application_features(application, master.FeatureConfig(accuracy=FINE_SKETCH))
    logs = [c for c in out.columns if c.endswith("_log")]
    return _rounded(out, [*logs, "ext_sources_std", "ext_sources_mean"], 6)


@query("fx_application", "fx_previous", "fx_installments")
def model_features(application, previous, installments):
    """Final model features."""
    out = master.model_features(application, previous, installments, config=master.FeatureConfig(accuracy=FINE_SKETCH), categories=["name_client_type", "name_contract_status"])
    return out.select(
        KEY, "target", "income_per_child", "previous_count", "days_decision_median", "goods_credit_ratio_median",
        "name_client_type_1_urgent", "name_contract_status_approved", "installments_count", "dpd_median", "late_payment_mean",
    )


# --- encoding and splits ----------------------------------------------------


@query("fx_application")
def one_hot(application):
    cols = ["code_gender", "flag_own_car", "name_education_type"]
    return encoding.apply_one_hot(application.select(KEY, *cols), encoding.fit_one_hot(application, cols))


@query("fx_application")
def label_index(application):
    """Alphabetical index, null after the last value."""
    cols = application.select(KEY, "organization_type", "name_education_type")
    for c in ("organization_type", "name_education_type"):
        cols = encoding.apply_label_index(cols, encoding.fit_label_index(application, c))
    return cols


@query("fx_application")
def label_index_table(application):
    """N3 with more values than literals may hold: index by joined table."""
    cols = application.select(KEY, "organization_type")
    return encoding.apply_label_index(cols, encoding.fit_label_index(application, "organization_type", literal_limit=5))


@query("fx_application")
def encode_mixed(application):
    """Few values to indicators, many to an index."""
    rows = application.select(KEY, "target", "code_gender", "organization_type", "name_education_type")
    return encoding.apply_encoder(rows, encoding.fit_encoder(rows))


@query("fx_application")
def hash_split(application):
    train, _ = encoding.hash_split(application, KEY, 0.8, method="md5")
    return train.select(KEY)


@query("fx_application")
def stratified_split(application):
    """The same fraction inside every class."""
    return encoding.stratified_split(application, "target", KEY, 0.8, method="md5").select(KEY, "target", "in_train")


@query("fx_application")
def class_weights(application):
    return encoding.class_weights(application, "target").select(KEY, "target", "class_weight")


@query("fx_application")
def bernoulli_sample(application):
    """Seeded sample of all rows."""
    return encoding.sample(application, KEY, 0.2, method="md5").select(KEY)


@query("fx_application")
def unpivot_amounts(application):
    return shaping.to_long(application, AMOUNT_COLUMNS, [KEY], "double")


@query("fx_application", "fx_monthly")
def skew_join(application, monthly):
    """D3: facts with their client label, hot clients by broadcast."""
    return joins.skew_join(monthly, application.select(KEY, "target"), KEY, parts=100).select("event_id", KEY, "target")


@query("fx_bureau_balance", "fx_bureau")
def bridge_join(balance, bureau):
    """Snapshots counted per credit, with their client."""
    counted = joins.count_rows(balance, ["sk_id_bureau", "months_balance"])
    return joins.bridge_join(counted, bureau, "sk_id_bureau", KEY)


# --- models -----------------------------------------------------------------


@query("fx_application")
def rank_features_pearson(application):
    """M5: continuous features by correlation with the label."""
    rows = application.select(KEY, "target", *CORR_COLUMNS, "flag_phone", "flag_email", "flag_document_3")
    ranked = modeling.rank_features(rows).filter(F.col("kind") == "continuous")
    return _rounded(ranked.select("feature", F.col("value").alias("pearson_corr"), F.col("strength").alias("abs_pearson_corr")), ["pearson_corr", "abs_pearson_corr"], 6)


@query("fx_application")
def rank_features_chi_square(application):
    """M5: two-valued features by chi-square test (statistic)."""
    rows = application.select(KEY, "target", *CORR_COLUMNS, "flag_phone", "flag_email", "flag_document_3")
    ranked = modeling.rank_features(rows).filter(F.col("kind") == "binary")
    return ranked.select("feature", F.round("value", 6).alias("statistic"))


@query("fx_application")
def rank_features_p_values(application):
    rows = application.select(KEY, "target", "flag_phone", "flag_email", "flag_document_3")
    ranked = modeling.rank_features(rows)
    return _rounded(ranked.select("feature", F.col("value").alias("statistic"), "p_value", "neg_log10_p"), ["statistic", "p_value", "neg_log10_p"], 6)


@query("fx_application")
def chi_square_table(application):
    out = modeling.chi_square_table(application, ["flag_phone", "flag_email", "flag_document_2", "flag_document_3"])
    return _rounded(out, ["statistic"], 6)


@query("fx_application")
def ml_ready(application):
    """Key, label and vector size of the fitted encoding pipeline."""
    from pyspark.ml.functions import vector_to_array

    out = encoding.ml_ready(master.application_base(application))
    return out.select(KEY, "label", F.size(vector_to_array("features")).alias("n_features"))


@query("fx_application")
def rule_metrics(application):
    """M7 on a rule-based prediction."""
    return _rounded(modeling.metrics(rule_predictions(application), model="rule").drop("meaning"), ["value"], 9)


@query("fx_application")
def confusion_counts(application):
    return modeling.confusion(rule_predictions(application))


@query("fx_application")
def confusion_report(application):
    return modeling.confusion_report(rule_predictions(application), "rule").drop("meaning")


@query("fx_application")
def confusion_pivot(application):
    """Shares within the true class as a matrix."""
    return shaping.confusion_pivot(modeling.confusion_report(rule_predictions(application), "rule"))


@query("fx_application")
def actual_vs_predicted(application):
    return modeling.actual_vs_predicted(rule_predictions(application))


@query("fx_application")
def positive_probabilities(application):
    """Second entry of a probability given as array and as text."""
    p = F.round(F.coalesce("ext_source_2", F.lit(0.0)), 3)
    rows = application.select(
        KEY,
        F.array(1.0 - p, p).alias("probability"),
        F.concat(F.lit("["), F.format_string("%.3f", 1.0 - p), F.lit(","), F.format_string("%.3f", p), F.lit("]")).alias("text"),
    )
    return rows.select(KEY, positive_probability(rows).alias("from_array"), positive_probability(rows, "text").alias("from_text"))


def _rounded(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


from creditloom.plans import lake_queries  # noqa: E402, F401  registers its queries
