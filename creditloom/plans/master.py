"""Client master tables and model features (A.1, R22, E21-E23)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.quantiles import SKETCH_ACCURACY
from creditloom.functions.rowexpr import (
    days_to_years, flag, log_amount, row_count_flags, row_stats, row_sum, safe_ratio,
)
from creditloom.operators.cleaning import (
    SENTINEL_DAYS, AnomalyRule, apply_fill, category, constant_columns, drop_header_rows, ensure_columns, fill_strings,
    fit_median, missing_flags, normalize_columns, null_anomaly, valid_label,
)
from creditloom.operators.encoding import apply_one_hot, fit_caps, fit_one_hot
from creditloom.operators.joins import assemble_master, attach
from creditloom.plans import blocks
from creditloom.plans.blocks import DEFAULT, KEY, Rounding
from creditloom.sources.blockstore import BlockStore

APPLICATION_COLUMNS = {
    "sk_id_curr": "bigint", "target": "int", "days_birth": "int", "days_employed": "int", "amt_credit": "double",
    "amt_income_total": "double", "amt_annuity": "double", "amt_goods_price": "double", "cnt_fam_members": "double",
    "code_gender": "string",
}
IMPUTED = ("amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "cnt_fam_members")


def application_features_basic(df: DataFrame) -> DataFrame:
    """Valid rows with age, employment, ratios and clean categories; lazy."""
    rows = ensure_columns(normalize_columns(df), APPLICATION_COLUMNS)
    rows = valid_label(drop_header_rows(rows, KEY))
    sentinel = F.col("days_employed") == SENTINEL_DAYS
    rows = rows.withColumns(
        {
            "age_years": days_to_years("days_birth"),
            "flag_days_employed_anomaly": flag(sentinel),
            "years_employed": F.when(~sentinel, days_to_years("days_employed")),
            "credit_income_ratio": safe_ratio("amt_credit", "amt_income_total", "positive"),
            "annuity_income_ratio": safe_ratio("amt_annuity", "amt_income_total", "positive"),
            "goods_credit_ratio": safe_ratio("amt_goods_price", "amt_credit", "positive"),
            "income_per_family_member": safe_ratio("amt_income_total", "cnt_fam_members", "positive"),
            "code_gender": category("code_gender", {"xna": "Unknown"}),
        }
    )
    return fill_strings(rows, "Unknown", blank=False)


def application_base(
    df: DataFrame, method: str = "approx", train: DataFrame | None = None, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """The cleaned application table. Medians are learned from ``train`` (a
    split of the same raw table) when given, so that no test row leaks in."""
    rows = application_features_basic(df)
    source = rows if train is None else application_features_basic(train)
    present = [c for c in IMPUTED if c in rows.columns]
    return apply_fill(rows, fit_median(source, present, method, accuracy), flags=True)


def application_analytic(df: DataFrame) -> DataFrame:
    """First version of the base: ratios null on a zero denominator."""
    sentinel = F.col("days_employed") == SENTINEL_DAYS
    return valid_label(df).withColumns(
        {
            "age_years": days_to_years("days_birth"),
            "days_employed_anomaly": flag(sentinel),
            "years_employed_clean": F.when(~sentinel, days_to_years("days_employed")),
            "credit_income_ratio": safe_ratio("amt_credit", "amt_income_total"),
            "annuity_income_ratio": safe_ratio("amt_annuity", "amt_income_total"),
            "goods_credit_ratio": safe_ratio("amt_goods_price", "amt_credit"),
            "code_gender_clean": category("code_gender", {"xna": "Unknown"}, null_as=None),
        }
    )


def _empty(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.sparkSession.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items()))


def _features(block: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in block.schema.fields if f.name != KEY}


def satellite_blocks(tables: Mapping[str, DataFrame | None], r: Rounding = DEFAULT) -> dict[str, DataFrame | None]:
    """The six blocks of the master; a missing table gives ``None``."""

    def one(name: str, block: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
        return block(tables[name]) if tables.get(name) is not None else None

    bureau, balance = tables.get("bureau"), tables.get("bureau_balance")
    return {
        "bureau": one("bureau", lambda d: blocks.bureau_features(d, r)),
        "bureau_balance": blocks.balance_features(balance, bureau, r) if bureau is not None and balance is not None else None,
        "previous_application": one("previous_application", lambda d: blocks.previous_features(d, r)),
        "installments_payments": one("installments_payments", lambda d: blocks.installment_features(d, r)),
        "pos_cash_balance": one("pos_cash_balance", lambda d: blocks.pos_features(d, r)),
        "credit_card_balance": one("credit_card_balance", lambda d: blocks.card_features(d, r)),
    }


def expected_features(base: DataFrame) -> dict[str, dict[str, str]]:
    """Names and types each block would add, read off the block on no rows."""
    bureau = _empty(base, blocks.BUREAU_COLUMNS)
    none = satellite_blocks(
        {
            "bureau": bureau,
            "bureau_balance": _empty(base, blocks.BALANCE_COLUMNS),
            "previous_application": _empty(base, blocks.PREVIOUS_COLUMNS),
            "installments_payments": _empty(base, blocks.INSTALLMENT_COLUMNS),
            "pos_cash_balance": _empty(base, blocks.POS_COLUMNS),
            "credit_card_balance": _empty(base, blocks.CARD_COLUMNS),
        }
    )
    return {name: _features(block) for name, block in none.items()}


def client_master(
    application: DataFrame, tables: Mapping[str, DataFrame | None], r: Rounding = DEFAULT, method: str = "approx",
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Cleaned application with all six blocks. All joins use the client key,
    on which every block is already partitioned by its aggregation."""
    base = application_base(application, method, accuracy=accuracy)
    aggregates = satellite_blocks(tables, r)
    missing = any(a is None for a in aggregates.values())
    return assemble_master(base, aggregates, KEY, expected_features(base) if missing else None)


BASE = "application"


def store_blocks(
    store: BlockStore, application: DataFrame | None, tables: Mapping[str, DataFrame | None], r: Rounding = DEFAULT,
    method: str = "approx", accuracy: int = SKETCH_ACCURACY,
) -> list[str]:
    """Write the cleaned application and the blocks whose tables are given, and
    only those: the way to load a store and to refresh one block. The balance
    block needs ``bureau`` for its bridge, so a new bureau table refreshes both
    where both are given. Names of what was written."""
    written = []
    if application is not None:
        store.write(BASE, application_base(application, method, accuracy=accuracy))
        written.append(BASE)
    for name, block in satellite_blocks(tables, r).items():
        if block is not None:
            store.write(name, block)
            written.append(name)
    return written


def stored_master(store: BlockStore) -> DataFrame:
    """The client master from stored blocks; a block never written gives typed
    null columns."""
    expected = expected_features(store.read(BASE))
    return store.assemble(BASE, list(expected), expected)


def analytic_master(application: DataFrame, tables: Mapping[str, DataFrame], digits: int | None = 2,
                    total: int | None = 2) -> DataFrame:
    """First version of the master: base with five short aggregates."""
    return assemble_master(
        application_analytic(application),
        {
            "bureau": blocks.bureau_summary(tables["bureau"], digits, total),
            "previous": blocks.previous_summary(tables["previous_application"], digits),
            "pos": blocks.pos_summary(tables["pos_cash_balance"], digits),
            "card": blocks.card_summary(tables["credit_card_balance"], digits),
            "installments": blocks.installment_summary(tables["installments_payments"], digits),
        },
        KEY,
    )


# --- wide application features ---------------------------------------------

# The column groups of the wide application block.
REQUESTS = ["hour", "day", "week", "mon", "qrt", "year"]
REQUEST_COLUMNS = [f"amt_req_credit_bureau_{w}" for w in REQUESTS]
SOCIAL_OBSERVED = ["obs_30_cnt_social_circle", "obs_60_cnt_social_circle"]
SOCIAL_DEFAULTED = ["def_30_cnt_social_circle", "def_60_cnt_social_circle"]
AMOUNTS = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"]
COUNTS = ["cnt_children", "cnt_fam_members", *SOCIAL_OBSERVED, *SOCIAL_DEFAULTED, *REQUEST_COLUMNS]
MISSING_FLAGS = [
    *SOCIAL_OBSERVED, *SOCIAL_DEFAULTED, "ext_source_2", "ext_source_3", "days_employed", "days_last_phone_change",
    "amt_annuity", "amt_goods_price", "cnt_fam_members", *REQUEST_COLUMNS,
]
EXTERNAL_SCORES = ["ext_source_1", "ext_source_2", "ext_source_3"]
CONTACTS = ["flag_emp_phone", "flag_work_phone", "flag_phone", "flag_email"]
ADDRESSES = [
    "reg_region_not_live_region", "reg_region_not_work_region", "live_region_not_work_region",
    "reg_city_not_live_city", "reg_city_not_work_city", "live_city_not_work_city",
]
CATEGORIES = [
    "name_contract_type", "code_gender", "flag_own_car", "flag_own_realty", "name_income_type", "name_education_type",
    "name_family_status", "name_housing_type", "weekday_appr_process_start",
]
DAY_YEARS = {
    "days_birth": "age_years",
    "days_employed": "employment_years",
    "days_registration": "registration_years",
    "days_id_publish": "id_publish_years",
    "days_last_phone_change": "last_phone_change_years",
}


def day_rules() -> dict[str, AnomalyRule]:
    """A birth on or after the application, any other event after it, and the
    sentinel are anomalies."""

    def future(c: Column) -> Column:
        return (c > 0) | (c == SENTINEL_DAYS)

    def birth(c: Column) -> Column:
        return (c >= 0) | (c == SENTINEL_DAYS)

    return {c: AnomalyRule(birth if c == "days_birth" else future, years) for c, years in DAY_YEARS.items()}


@dataclass(frozen=True)
class FeatureConfig:
    one_hot: bool = True
    drop_document_flags: bool = False
    drop_constant: bool = True
    amount_q: float = 0.995
    count_q: float = 0.99
    ratio_q: float = 0.995
    method: str = "approx"
    accuracy: int = SKETCH_ACCURACY
    keep: tuple[str, ...] = (KEY, "target")


def smoothed_ratios(cols: Sequence[str]) -> dict[str, Column]:
    """Smoothed ratios whose inputs exist."""
    seen = set(cols)
    observed = [c for c in SOCIAL_OBSERVED if c in seen]
    defaulted = [c for c in SOCIAL_DEFAULTED if c in seen]
    table = [
        ("credit_income_ratio", "amt_credit", "amt_income_total", 1.0, None),
        ("annuity_income_ratio", "amt_annuity", "amt_income_total", 1.0, None),
        ("annuity_credit_ratio", "amt_annuity", "amt_credit", 1.0, None),
        ("goods_credit_ratio", "amt_goods_price", "amt_credit", 1.0, None),
        ("income_per_family_member", "amt_income_total", "cnt_fam_members", 1.0, 1.0),
        ("income_per_child", "amt_income_total", "cnt_children", 1.0, None),
        ("employment_age_ratio", "employment_years", "age_years", 1e-6, None),
        ("children_family_ratio", "cnt_children", "cnt_fam_members", 1e-6, 1.0),
    ]
    out = {
        name: safe_ratio(num, den, offset=offset, den_default=default)
        for name, num, den, offset, default in table
        if {num, den} <= seen
    }
    if observed and defaulted:
        out["social_def_ratio"] = safe_ratio(row_sum(defaulted), row_sum(observed), offset=1.0)
    return out


def row_features(cols: Sequence[str]) -> dict[str, Column]:
    """Row statistics, totals and indicator counts of the groups that exist."""
    def here(group: Sequence[str]) -> list[str]:
        return [c for c in group if c in cols]

    out: dict[str, Column] = {}
    if len(here(EXTERNAL_SCORES)) >= 2:
        out |= row_stats(here(EXTERNAL_SCORES), "ext_sources")
    sums = {
        "bureau_requests_total": here(REQUEST_COLUMNS),
        "bureau_requests_recent": here(REQUEST_COLUMNS[:4]),
        "social_obs_total": here(SOCIAL_OBSERVED),
        "social_def_total": here(SOCIAL_DEFAULTED),
    }
    counts = {
        "num_contact_channels": here(CONTACTS),
        "address_mismatch_count": here(ADDRESSES),
        "num_documents_provided": [c for c in cols if c.startswith("flag_document_")],
    }
    out |= {name: row_sum(group) for name, group in sums.items() if group}
    return out | {name: row_count_flags(group) for name, group in counts.items() if group}


def application_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The wide application block.

    Amounts, counts and ratios are capped at quantiles that all come from one
    aggregate: ratios use uncapped inputs, so their caps need no second stage.
    Missing flags are taken before anomalous days become null.
    """
    lower = df.toDF(*[c.lower() for c in df.columns])
    base = null_anomaly(missing_flags(lower, MISSING_FLAGS), day_rules())
    cols = base.columns
    amounts, counts = [c for c in AMOUNTS if c in cols], [c for c in COUNTS if c in cols]
    ratios = smoothed_ratios(cols)
    probs: dict[str, float | tuple[Column, float]] = {c: config.amount_q for c in amounts}
    probs |= {c: config.count_q for c in counts}
    probs |= {f"{n}_raw": (e, config.ratio_q) for n, e in ratios.items()}
    caps = fit_caps(base, probs, config.method, config.accuracy)
    types = {f.name: f.dataType for f in base.schema.fields}
    new: dict[str, Column] = {}
    for c in amounts:
        new[f"{c}_cap"] = caps.capped(c, dtype=types[c])
        new[f"{c}_log"] = log_amount(new[f"{c}_cap"])
    for c in counts:
        new[f"{c}_cap"] = caps.capped(c, dtype=types[c])
    new |= row_features(cols)
    new |= {n: caps.capped(f"{n}_raw", e) for n, e in ratios.items()}
    out = base.withColumns(new)
    if config.drop_document_flags:
        out = out.drop(*[c for c in cols if c.startswith("flag_document_")])
    if config.one_hot:
        categories = [c for c in CATEGORIES if c in cols]
        out = apply_one_hot(out, fit_one_hot(lower, categories))
    if config.drop_constant:
        out = out.drop(*[c for c in constant_columns(out, first=1000) if c not in config.keep])
    return out


def model_features(
    application: DataFrame, previous: DataFrame, installments: DataFrame, config: FeatureConfig = FeatureConfig(),
    categories: Sequence[str] = blocks.PREVIOUS_CATEGORIES,
) -> DataFrame:
    """Application block with previous-application and payment behaviour."""
    behaviour = blocks.installment_behaviour(installments)
    wide = attach(application_features(application, config), blocks.previous_model_features(previous, categories), KEY)
    return attach(wide, behaviour, KEY)
