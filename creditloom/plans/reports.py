"""Analytical reports (E1-E20): parameterised compositions of the operators.

Percentages and averages are unrounded unless ``digits`` is given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.quantiles import exact_quantiles
from creditloom.functions.rowexpr import Buckets, days_to_years, keep_if, safe_ratio
from creditloom.operators.cleaning import category, valid_label
from creditloom.operators.entity import Metric, corr_with, entity_aggregate, global_aggregate, safe_corr
from creditloom.operators.joins import attach
from creditloom.operators.profiling import category_rate, label_distribution, null_profile, numeric_summary, per_column
from creditloom.operators.shaping import latest_per, order_by_rank, pivot_rate, share_of_total, top_k
from creditloom.plans.blocks import KEY, LATE_STATUSES, below_minimum, status, utilisation

# Bin edges of the bucket reports.
DPD = Buckets((0, 30, 60, 90), ("0", "1-30", "31-60", "61-90", "90+"))
OVERDUE = Buckets((0, 30, 60, 90), ("not overdue", "1-30 days", "31-60 days", "61-90 days", "90+ days"))
UTILISATION = Buckets((0.25, 0.5, 0.75, 1.0), ("0-25%", "25-50%", "50-75%", "75-100%", ">100%"), null_label="no limit")
UTILISATION_PCT = Buckets((25, 50, 75, 100), ("0-25%", "25-50%", "50-75%", "75-100%", ">100%"), null_label="N/A")
AMOUNT = Buckets(
    (50_000, 100_000, 500_000, 1_000_000),
    ("1 - 50k", "50k - 100k", "100k - 500k", "500k - 1M", "> 1M"),
    null_label="N/A",
    zero_label="0",
)
SEVERITY = Buckets((0, 2), ("no past arrears", "mild past arrears", "severe past arrears"))

# Reporting groups of the credit state.
CREDIT_STATES = {
    "active": "Active", "closed": "Closed", "sold": "Sold", "bad debt": "Bad debt", "bad_debt": "Bad debt",
}


def status_distribution(df: DataFrame, column: str, value: Column | None = None, distinct: str | None = None,
                        digits: int | None = None, extra: Sequence[Metric] = ()) -> DataFrame:
    """Rows and percentage per status, optionally with distinct entities."""
    more = [*extra, *([Metric("distinct_entities", "count_distinct", distinct)] if distinct else [])]
    group = {column: value if value is not None else F.col(column)}
    return share_of_total(df, group, digits=digits, extra=more)


def credit_state_distribution(bureau: DataFrame, digits: int | None = None) -> DataFrame:
    state = F.coalesce(category("credit_active", CREDIT_STATES, null_as=None, other="Other"), F.lit("Other"))
    return status_distribution(bureau, "credit_state", state, digits=digits)


def credit_type_distribution(bureau: DataFrame, digits: int | None = None) -> DataFrame:
    return status_distribution(bureau, "credit_type", category("credit_type"), KEY, digits)


def balance_status_distribution(snapshots: DataFrame, digits: int | None = None) -> DataFrame:
    s = status("status", "X")
    late = Metric("late_pct", "pct", where=s.isin(*LATE_STATUSES), digits=digits)
    return status_distribution(snapshots, "status", s, digits=digits, extra=[late])


def arrears_statistics(df: DataFrame, cols: Sequence[str] = ("sk_dpd", "sk_dpd_def"), method: str = "approx",
                       digits: int | None = None) -> DataFrame:
    """Summary of past-due columns with the number of rows in arrears."""
    summary = numeric_summary(df, cols, {"median": 0.5, "p90": 0.9, "p99": 0.99}, method, digits=digits)
    arrears = per_column(df, cols, lambda c: {"rows_in_arrears": F.count_if(F.col(c) > 0)})
    return summary.join(arrears, "variable")


def bucket_distribution(df: DataFrame, value: Column, buckets: Buckets, name: str = "bucket", digits: int | None = None,
                        extra: Sequence[Metric] = ()) -> DataFrame:
    """Rows and percentage per bucket, in bucket order."""
    shares = share_of_total(df, {name: buckets.label(value)}, digits=digits, extra=extra)
    return order_by_rank(shares, name, buckets.order)


def bucket_by_label(clients: DataFrame, value: str | Column, buckets: Buckets, label: str = "target", name: str = "bucket") -> DataFrame:
    c = F.col(value) if isinstance(value, str) else value
    return clients.groupBy(F.col(label), buckets.label(c).alias(name)).agg(F.count(F.lit(1)).alias("clients"))


def utilisation_distribution(card: DataFrame, digits: int | None = None) -> DataFrame:
    known = card.filter(F.col("amt_balance").isNotNull() & F.col("amt_credit_limit_actual").isNotNull())
    return bucket_distribution(known, utilisation(), UTILISATION, digits=digits)


def overdue_distribution(bureau: DataFrame, digits: int | None = None) -> DataFrame:
    amount = Metric("avg_amt_overdue", "avg", "amt_credit_sum_overdue", digits=digits)
    return bucket_distribution(bureau, F.coalesce("credit_day_overdue", F.lit(0)), OVERDUE, digits=digits, extra=[amount])


def balance_statistics(card: DataFrame, digits: int | None = None) -> DataFrame:
    """Balance range, average, median, p90, average limit and utilisation of
    rows that have both a balance and a limit."""
    known = card.filter(F.col("amt_balance").isNotNull() & F.col("amt_credit_limit_actual").isNotNull())
    return global_aggregate(
        known,
        [
            Metric("min_balance", "min", "amt_balance", digits=digits),
            Metric("max_balance", "max", "amt_balance", digits=digits),
            Metric("avg_balance", "avg", "amt_balance", digits=digits),
            Metric("median_balance", "quantile", "amt_balance", q=0.5, digits=digits),
            Metric("p90_balance", "quantile", "amt_balance", q=0.9, digits=digits),
            Metric("avg_limit", "avg", "amt_credit_limit_actual", digits=digits),
            Metric("avg_utilisation_pct", "avg", utilisation() * F.lit(100.0), digits=digits),
        ],
    )


def term_distribution(pos: DataFrame, k: int = 20) -> DataFrame:
    terms = pos.filter(F.col("cnt_instalment").isNotNull()).groupBy(F.col("cnt_instalment").cast("int").alias("term"))
    return top_k(terms.agg(F.count(F.lit(1)).alias("n")), "n", k, "term")


def progress_summary(pos: DataFrame, digits: int | None = None) -> DataFrame:
    total, left = F.col("cnt_instalment"), F.col("cnt_instalment_future")
    return global_aggregate(
        pos.filter(total.isNotNull() & left.isNotNull()),
        [
            Metric("avg_term", "avg", total, digits=digits),
            Metric("avg_remaining", "avg", left, digits=digits),
            Metric("avg_paid", "avg", total - left, digits=digits),
            Metric("avg_progress_pct", "avg", safe_ratio(total - left, total, "positive") * F.lit(100.0), digits=digits),
        ],
    )


def month_trend(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    return entity_aggregate(df, "months_balance", [Metric("n", "count"), *metrics]).orderBy("months_balance")


def pos_trend(pos: DataFrame, digits: int | None = None) -> DataFrame:
    late = F.col("sk_dpd") > 0
    return month_trend(
        pos,
        [
            Metric("in_arrears", "count", where=late),
            Metric("arrears_pct", "pct", where=late, digits=digits),
            Metric("avg_dpd", "avg", "sk_dpd", digits=digits),
        ],
    )


def card_trend(card: DataFrame, digits: int | None = None) -> DataFrame:
    return month_trend(
        card,
        [
            Metric("avg_balance", "avg", "amt_balance", digits=digits),
            Metric("utilisation_pct", "avg", utilisation() * F.lit(100.0), digits=digits),
            Metric("avg_dpd", "avg", "sk_dpd", digits=digits),
            Metric("in_arrears", "count", where=F.col("sk_dpd") > 0),
        ],
    )


def balance_trend(snapshots: DataFrame, digits: int | None = None) -> DataFrame:
    s = status("status", "X")
    return month_trend(
        snapshots,
        [
            Metric("late_pct", "pct", where=s.isin(*LATE_STATUSES), digits=digits),
            Metric("closed_pct", "pct", where=s == "C", digits=digits),
            Metric("unknown_pct", "pct", where=s == "X", digits=digits),
        ],
    )


def label_summary(
    clients: DataFrame, averages: Mapping[str, str], label: str = "target", digits: int | None = None,
    quantiles: Mapping[str, tuple[str, float]] | None = None, exact: bool = False,
) -> DataFrame:
    """Averages (and quantiles) of client features per label value.

    With ``exact`` the quantiles come from ``exact_quantiles``: a label has few
    values, so one buffer per label could never hold all clients.
    """
    metrics = [Metric("clients", "count")]
    metrics += [Metric(n, "avg", c, digits=digits) for n, c in averages.items()]
    wanted = dict(quantiles or {})
    if not exact:
        metrics += [Metric(n, "quantile", c, q=q) for n, (c, q) in wanted.items()]
    out = entity_aggregate(clients, label, metrics)
    if exact and wanted:
        cols, qs = sorted({c for c, _ in wanted.values()}), sorted({q for _, q in wanted.values()})
        long = exact_quantiles(clients, cols, qs, [label])
        wide = long.groupBy(label).agg(
            *[
                F.max(F.when((F.col("variable") == c) & (F.col("q") == F.lit(float(q))), F.col("value"))).alias(n)
                for n, (c, q) in wanted.items()
            ]
        )
        wide = wide.withColumnRenamed(label, "_label")
        out = out.join(wide, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
    return out


def labelled_summary(application: DataFrame, aggregate: DataFrame, averages: Mapping[str, str], digits: int | None = None) -> DataFrame:
    """Averages of an aggregate per label over all labelled clients."""
    base = valid_label(application).select(KEY, "target")
    return label_summary(attach(base, aggregate, KEY), averages, digits=digits)


def last_status_by_label(snapshots: DataFrame, labels: DataFrame, order: str = "months_balance", tie: str = "event_id") -> DataFrame:
    """Clients and contracts by latest contract status and label.

    Contracts are counted per (client, status) before the label join, which
    leaves one row per pair: distinct clients are then a plain row count.
    """
    latest = latest_per(snapshots, [KEY, "sk_id_prev"], order, tie, ["name_contract_status"])
    per_client = latest.groupBy(KEY, "name_contract_status").agg(F.count(F.lit(1)).alias("contracts"))
    labelled = per_client.join(valid_label(labels).select(KEY, "target"), KEY)
    return labelled.groupBy("name_contract_status", "target").agg(
        F.count(F.lit(1)).alias("clients"), F.sum("contracts").alias("contracts")
    )


def payments_summary(card: DataFrame, digits: int | None = None) -> DataFrame:
    names = {
        "avg_drawings": "amt_drawings_current", "avg_atm": "amt_drawings_atm_current",
        "avg_pos": "amt_drawings_pos_current", "avg_other": "amt_drawings_other_current",
        "avg_payment": "amt_payment_current", "avg_minimum": "amt_inst_min_regularity",
    }
    return global_aggregate(
        card,
        [
            *[Metric(n, "avg", c, digits=digits) for n, c in names.items()],
            Metric("pct_below_minimum", "pct", where=below_minimum(), digits=digits),
        ],
    )


AMOUNT_CHANNELS = {
    "ATM": "amt_drawings_atm_current", "POS": "amt_drawings_pos_current", "Other": "amt_drawings_other_current",
}


def amount_mix(card: DataFrame, channels: Mapping[str, str] = AMOUNT_CHANNELS, digits: int | None = None) -> DataFrame:
    """Positive amounts per channel, all channels from one scan."""
    def fields(channel: str) -> dict[str, Column]:
        amount = F.sum(keep_if(channels[channel], F.col(channels[channel]) > 0))
        return {"total_amount": F.round(amount, digits) if digits is not None else amount}

    return per_column(card, list(channels), fields).withColumnRenamed("variable", "channel")


def arrears_by(df: DataFrame, group: Mapping[str, Column], days: Column, digits: int | None = None,
               extra: Sequence[Metric] = ()) -> DataFrame:
    """Rows, rows in arrears and their percentage per group."""
    return df.groupBy(*[c.alias(n) for n, c in group.items()]).agg(
        *[
            m.column()
            for m in (
                Metric("n", "count"),
                Metric("in_arrears", "count", where=days > 0),
                Metric("arrears_pct", "pct", where=days > 0, digits=digits),
                *extra,
            )
        ]
    )


def overdue_global(bureau: DataFrame, digits: int | None = None) -> DataFrame:
    days, amount = F.coalesce("credit_day_overdue", F.lit(0)), F.coalesce("amt_credit_sum_overdue", F.lit(0.0))
    return global_aggregate(
        bureau,
        [
            Metric("credits", "count"),
            Metric("overdue_credits", "count", where=days > 0),
            Metric("overdue_pct", "pct", where=days > 0, digits=digits),
            Metric("avg_days_overdue", "avg", days, digits=digits),
            Metric("avg_amt_overdue", "avg", amount, digits=digits),
        ],
    )


def overdue_by_type(bureau: DataFrame, digits: int | None = None) -> DataFrame:
    days = F.coalesce("credit_day_overdue", F.lit(0))
    extra = [
        Metric("avg_days_overdue", "avg", days, digits=digits),
        Metric("total_amt_overdue", "sum0", "amt_credit_sum_overdue", digits=2),
    ]
    return arrears_by(bureau, {"credit_type": category("credit_type")}, days, digits, extra)


def coverage_class(base: DataFrame, sources: Mapping[str, DataFrame], key: str = KEY, name: str = "coverage") -> DataFrame:
    """Label each base row by which of two sources know its key: ``both``,
    ``only <source>`` or ``none``. Sources are reduced to distinct keys, so
    their size per key does not matter."""
    if len(sources) != 2:
        raise ValueError("coverage compares two sources")
    out, marks = base, []
    for i, (source, df) in enumerate(sources.items()):
        mark = f"_in{i}"
        out = out.join(df.select(key).distinct().withColumn(mark, F.lit(True)), key, "left")
        marks.append((source, F.col(mark).isNotNull(), mark))
    (a, in_a, _), (b, in_b, _) = marks
    label = F.when(in_a & in_b, "both").when(in_a, f"only {a}").when(in_b, f"only {b}").otherwise("none")
    return out.withColumn(name, label).drop(*[m for *_, m in marks])


def coverage_by_label(application: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Clients per coverage class and label with the default rate."""
    classes = coverage_class(valid_label(application).select(KEY, "target"), sources)
    return pivot_rate(classes, "coverage", rate="default_rate_pct")


def temporal_summary(bureau: DataFrame, labels: DataFrame, digits: int | None = None) -> DataFrame:
    """Ages of credits in years by client label; credits of unknown clients
    keep a null label.

    Ages are summed up per client before the label join (sums and counts of
    each column), so a client with very many credits is one row there. The
    median needs single credits: they are counted per (client, age) first.
    """
    ages = {
        "credit_age_years": days_to_years("days_credit", "neg"),
        "expected_remaining_years": days_to_years("days_credit_enddate", "keep"),
        "actual_end_years": days_to_years("days_enddate_fact", "neg"),
        "update_age_years": days_to_years("days_credit_update", "neg"),
    }
    wide = bureau.select(KEY, *[e.alias(n) for n, e in ages.items()])
    per_client = wide.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("credits"),
        *[F.sum(n).alias(f"s_{n}") for n in ages],
        *[F.count(n).alias(f"n_{n}") for n in ages],
    )
    known = labels.select(KEY, "target")
    means = {n: F.try_divide(F.sum(f"s_{n}"), F.sum(f"n_{n}")) for n in ages}
    by_label = attach(per_client, known, KEY).groupBy("target").agg(
        F.sum("credits").alias("credits"),
        *[(F.round(m, digits) if digits is not None else m).alias(f"avg_{n}") for n, m in means.items()],
    )
    counted = wide.filter(F.col("credit_age_years").isNotNull()).groupBy(KEY, "credit_age_years").agg(
        F.count(F.lit(1)).alias("rows")
    )
    aged = attach(counted, known, KEY).groupBy("target", "credit_age_years").agg(F.sum("rows").alias("rows"))
    median = weighted_median(aged, "credit_age_years", "rows", "target", "median_credit_age_years")
    median = median.withColumnRenamed("target", "_t")
    return by_label.join(median, F.col("target").eqNullSafe(F.col("_t")), "left").drop("_t")


def weighted_median(counts: DataFrame, value: str, weight: str, group: str, name: str) -> DataFrame:
    """Smallest value reaching half of its group's weight. Meant for counted
    day offsets: a group has a few thousand different ones, however many rows
    they stand for."""
    by_group = Window.partitionBy(group)
    upto = by_group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select(group, value, F.sum(weight).over(upto).alias("_seen"), F.sum(weight).over(by_group).alias("_all"))
    return ranked.filter(F.col("_seen") * 2 >= F.col("_all")).groupBy(group).agg(F.min(value).alias(name))


def combined_frame(bureau_profile: DataFrame, balance_profile: DataFrame) -> DataFrame:
    """Client frame of both bureau sources, matched on client and label."""
    return attach(bureau_profile, balance_profile, [KEY, "target"])


def severity_rate(combined: DataFrame, digits: int | None = None) -> DataFrame:
    """Default rate by class of the worst past status."""
    worst = F.coalesce("bb_worst_status_numeric", F.lit(0))
    rate = F.count_if(F.col("target") == 1) * F.lit(100.0) / F.count(F.lit(1))
    return combined.groupBy(SEVERITY.label(worst).alias("severity")).agg(
        F.count(F.lit(1)).alias("clients"),
        F.count_if(F.col("target") == 1).alias("defaults"),
        (F.round(rate, digits) if digits is not None else rate).alias("default_rate_pct"),
    )


def age_income_by_label(application: DataFrame, digits: int | None = None, exact: bool = False) -> DataFrame:
    rows = valid_label(application).select("target", days_to_years("days_birth").alias("age_years"), "amt_income_total")
    return label_summary(
        rows,
        {"avg_age_years": "age_years", "avg_income": "amt_income_total"},
        digits=digits,
        quantiles={"median_age_years": ("age_years", 0.5), "median_income": ("amt_income_total", 0.5)},
        exact=exact,
    )


EXTERNAL = ("ext_source_1", "ext_source_2", "ext_source_3")


def score_summary(application: DataFrame, cols: Sequence[str] = EXTERNAL, digits: int | None = None) -> DataFrame:
    """Count, mean, median and label correlation of the external scores, all
    from one scan."""
    def fields(c: str) -> dict[str, Column]:
        v = F.col(c)
        out = {"mean": F.avg(v), "corr_target": safe_corr("target", c)}
        if digits is not None:
            out = {n: F.round(e, digits) for n, e in out.items()}
        return {"n": F.count(v), "median": F.percentile_approx(v, 0.5, 10_000), **out}

    return per_column(valid_label(application), cols, fields)


def correlation_ranking(df: DataFrame, cols: Sequence[str], label: str = "target", digits: int | None = 6) -> DataFrame:
    ranked = corr_with(valid_label(df, label), label, [c for c in cols if c in df.columns], digits)
    return ranked.orderBy(F.desc_nulls_last("abs_corr"), "variable")


def financial_ratios(bureau: DataFrame, digits: int | None = None, method: str = "approx") -> DataFrame:
    """Distribution of debt, overdue and limit relative to the credit sum."""
    names = {"debt_ratio": "amt_credit_sum_debt", "overdue_ratio": "amt_credit_sum_overdue", "limit_ratio": "amt_credit_sum_limit"}
    ratios = bureau.select(*[safe_ratio(c, "amt_credit_sum", "positive").alias(n) for n, c in names.items()])
    return numeric_summary(ratios, list(names), {"median": 0.5, "p90": 0.9}, method, digits=digits)


def chart_tables(master: DataFrame, corr_cols: Sequence[str], category: str = "name_education_type", k: int = 10) -> dict[str, DataFrame]:
    """Inputs of the findings page."""
    rates = master.groupBy(category).agg(
        F.count(F.lit(1)).alias("total"),
        (F.sum("target") * F.lit(100.0) / F.count(F.lit(1))).alias("default_rate_pct"),
    )
    return {
        "label": label_distribution(master),
        "category_rate": rates.orderBy(F.desc("default_rate_pct"), category),
        "correlation": correlation_ranking(master, corr_cols).limit(k),
        "nulls": null_profile(master, k),
    }


# Business rules of the bureau table.
def bureau_rules() -> dict[str, Column]:
    state, fact = F.lower("credit_active"), F.col("days_enddate_fact")
    debt, total = F.coalesce("amt_credit_sum_debt", F.lit(0.0)), F.coalesce("amt_credit_sum", F.lit(0.0))
    return {
        "active with factual end": (state == "active") & fact.isNotNull(),
        "closed or sold without factual end": state.isin("closed", "sold") & fact.isNull(),
        "negative debt": F.col("amt_credit_sum_debt") < 0,
        "negative overdue": F.col("amt_credit_sum_overdue") < 0,
        "zero credit with debt": (total == 0) & (debt > 0),
        "positive days_credit": F.col("days_credit") > 0,
        "positive days_credit_update": F.col("days_credit_update") > 0,
    }
