"""Column and row cleaning."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.quantiles import exact_quantiles
from creditloom.functions.rowexpr import days_to_years, flag

# The sentinel day offset and the columns it is known to occur in.
SENTINEL_DAYS = 365243
SENTINEL_COLUMNS = (
    "days_employed",
    "days_first_drawing",
    "days_first_due",
    "days_last_due_1st_version",
    "days_last_due",
    "days_termination",
)


def columns_of(df: DataFrame, kind: type | tuple[type, ...], exclude: Iterable[str] = ()) -> list[str]:
    """Column names of a type family, without ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, T.NumericType, exclude)


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_of(df, T.StringType, exclude)


def normalize_columns(df: DataFrame) -> DataFrame:
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalisation: {sorted(names)}")
    return df.toDF(*names)


def ensure_columns(df: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed nulls (a bare null would have void type)."""
    absent = {c: F.lit(None).cast(t) for c, t in required.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def drop_header_rows(df: DataFrame, key: str) -> DataFrame:
    """Drop rows that repeat the header in the key column, and null keys."""
    text = F.col(key).cast("string")
    return df.filter(F.upper(text) != F.lit(key.upper()))


def valid_label(df: DataFrame, column: str = "target", domain: Sequence[int] = (0, 1)) -> DataFrame:
    """Keep rows whose label lies in the domain; the label becomes int."""
    kind = df.schema[column].dataType
    as_int = F.col(column).try_cast("int") if isinstance(kind, T.StringType) else F.col(column).cast("int")
    if isinstance(kind, T.IntegerType):
        return df.filter(F.col(column).isin(list(domain)))
    return df.filter(as_int.isin(list(domain))).withColumn(column, as_int)


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def null_sentinel(
    df: DataFrame,
    cols: Sequence[str] = SENTINEL_COLUMNS,
    value: float = SENTINEL_DAYS,
    flag_suffix: str | None = None,
) -> DataFrame:
    """Sentinel to null; with ``flag_suffix`` the flag is taken in the same
    step, before the value is gone."""
    present = [c for c in cols if c in df.columns]
    new = {c: F.when(F.col(c) != F.lit(value), F.col(c)) for c in present}
    if flag_suffix:
        new |= {f"{c}{flag_suffix}": flag(F.col(c) == F.lit(value)) for c in present}
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class AnomalyRule:
    """A day column is invalid when ``bad(column)`` holds; ``years`` names a
    sign-flipped copy in years."""

    bad: Callable[[Column], Column]
    years: str | None = None


def null_anomaly(df: DataFrame, rules: Mapping[str, AnomalyRule], flag_suffix: str = "_anom_flag") -> DataFrame:
    new: dict[str, Column] = {}
    for name, rule in rules.items():
        if name not in df.columns:
            continue
        bad = rule.bad(F.col(name))
        kept = F.when(~bad, F.col(name))
        new[name] = kept
        new[f"{name}{flag_suffix}"] = flag(bad)
        if rule.years:
            new[rule.years] = days_to_years(kept, "neg")
    return df.withColumns(new) if new else df


def missing_flags(df: DataFrame, cols: Sequence[str], suffix: str = "_missing_flag", prefix: str = "") -> DataFrame:
    new = {f"{prefix}{c}{suffix}": flag(F.col(c).isNull()) for c in cols if c in df.columns}
    return df.withColumns(new) if new else df


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """Null share per column, one aggregate over one scan."""
    cols = list(cols or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    ).first()
    return {c: (row[f"n{i}"] / row["_rows"] if row["_rows"] else 0.0) for i, c in enumerate(cols)}


def sparse_columns(df: DataFrame, threshold: float = 0.4, keep: Iterable[str] = ()) -> list[str]:
    candidates = [c for c in df.columns if c not in set(keep)]
    return [c for c, share in null_shares(df, candidates).items() if share >= threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.4, keep: Iterable[str] = ()) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold, keep))


def drop_sparse_rows(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Drop rows with more than ``threshold`` of their columns null."""
    nulls = reduce(add, [F.col(c).isNull().cast("int") for c in df.columns])
    return df.filter(nulls / F.lit(float(len(df.columns))) <= threshold)


def fill_strings(
    df: DataFrame, value: str = "UNKNOW", cols: Sequence[str] | None = None, blank: bool = True
) -> DataFrame:
    """Null (and, with ``blank``, empty or whitespace) strings to a constant."""
    new = {}
    for c in cols if cols is not None else string_columns(df):
        absent = F.col(c).isNull()
        if blank:
            absent = absent | (F.trim(F.col(c)) == "")
        new[c] = F.when(absent, F.lit(value)).otherwise(F.col(c))
    return df.withColumns(new) if new else df


def category(c: str | Column, aliases: Mapping[str, str] | None = None, null_as: str | None = "Unknown",
             case: str | None = None, other: str | None = None) -> Column:
    """Normalised category: alias lookup on the lower-cased value, then the
    value itself (or ``other``), in ``case``; null becomes ``null_as``."""
    raw = F.col(c) if isinstance(c, str) else c
    out = raw
    if aliases:
        low, chain = F.lower(raw), None
        for key, value in aliases.items():
            cond = low == F.lit(key.lower())
            chain = F.when(cond, F.lit(value)) if chain is None else chain.when(cond, F.lit(value))
        out = chain.otherwise(F.lit(other) if other is not None else raw)
    if null_as is not None:
        out = F.coalesce(out, F.lit(null_as))
    return {"upper": F.upper, "lower": F.lower}[case](out) if case else out


def normalize_category(df: DataFrame, column: str, aliases: Mapping[str, str] | None = None, **options) -> DataFrame:
    return df.withColumn(column, category(column, aliases, **options))


def fill_numeric(df: DataFrame, value: float = 0, cols: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=list(cols) if cols is not None else numeric_columns(df))


@dataclass(frozen=True)
class FillModel:
    """Learned replacement per column."""

    values: dict[str, float] = field(default_factory=dict)


#: Columns whose sketches one task merges, and rows that each row is cut into at most.
TOGETHER, MOST_PLACES = 4, 100


def median_rows(df: DataFrame, cols: Sequence[str], accuracy: int) -> DataFrame:
    """``place, m0, m1, ...``: medians of the columns ``place``, ``place + places``, ...

    One aggregate without a key would merge the sketches of all columns and all
    partitions in one task, whose time goes with columns times partitions.
    """
    width = max(TOGETHER, -(-len(cols) // MOST_PLACES))
    places = -(-len(cols) // width)
    none = F.lit(None).cast("double")
    cells = F.array(*[
        F.struct(*[(F.col(cols[i]).cast("double") if i < len(cols) else none).alias(f"v{w}") for w, i in enumerate(range(p, places * width, places))])
        for p in range(places)
    ])
    long = df.select(F.posexplode(cells).alias("place", "cell"))
    return long.groupBy("place").agg(*[F.percentile_approx(F.col(f"cell.v{w}"), 0.5, accuracy).alias(f"m{w}") for w in range(width)])


def fit_median(df: DataFrame, cols: Sequence[str] | None = None, method: str = "approx", accuracy: int = 10_000) -> FillModel:
    """Median of every column in one pass. Fit on the training split only and
    apply anywhere. A column without values is left out."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return FillModel()
    if method == "exact":
        rows = exact_quantiles(df, cols, [0.5]).collect()
        return FillModel({r["variable"]: r["value"] for r in rows})
    if len(cols) > 2 * TOGETHER:
        found = {r["place"]: r[1:] for r in median_rows(df, cols, accuracy).collect()}
        medians = [m for of_width in zip(*(found[p] for p in sorted(found)), strict=True) for m in of_width]
    else:
        medians = df.agg(*[F.percentile_approx(F.col(c), 0.5, accuracy).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    # without any row there are no places
    return FillModel({c: float(m) for c, m in zip(cols, medians, strict=False) if m is not None})


def apply_fill(df: DataFrame, model: FillModel, flags: bool = False, flag_prefix: str = "flag_missing_") -> DataFrame:
    new: dict[str, Column] = {}
    for c, v in model.values.items():
        if flags:
            new[f"{flag_prefix}{c}"] = flag(F.col(c).isNull())
        new[c] = F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
    return df.withColumns(new) if new else df


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None, first: int = 0) -> list[str]:
    """Columns with a single value, null counting as a value. Compares min with
    max, so no distinct sets are built. Where rows are cheap to begin with,
    ``first`` of them settle most columns: two values anywhere are two values;
    the others are compared over all rows."""
    cols = list(cols or df.columns)
    if first:
        cols = constant_columns(df.limit(first), cols)
        if not cols:
            return []
    parts = []
    for i, c in enumerate(cols):
        parts += [
            F.count(F.lit(1)).alias("_rows") if i == 0 else None,
            F.count(F.col(c)).alias(f"n{i}"),
            (F.min(F.col(c)).eqNullSafe(F.max(F.col(c)))).alias(f"same{i}"),
        ]
    row = df.agg(*[p for p in parts if p is not None]).first()
    return [
        c for i, c in enumerate(cols) if row[f"n{i}"] == 0 or (row[f"n{i}"] == row["_rows"] and row[f"same{i}"])
    ]


def drop_constant_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    skip = set(keep)
    return df.drop(*[c for c in constant_columns(df) if c not in skip])


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


@dataclass(frozen=True)
class CleanConfig:
    """One table's route from raw to trusted."""

    protected: tuple[str, ...] = ()
    sentinel_columns: tuple[str, ...] = SENTINEL_COLUMNS
    column_threshold: float = 0.4
    row_threshold: float = 0.7
    partition_by: tuple[str, ...] = ()


# Protected key columns and partitioning of the seven tables.
TABLE_CONFIGS = {
    "application_train": CleanConfig(("sk_id_curr", "target"), partition_by=("weekday_appr_process_start",)),
    "bureau": CleanConfig(("sk_id_curr", "sk_id_bureau")),
    "bureau_balance": CleanConfig(("sk_id_bureau",)),
    "previous_application": CleanConfig(("sk_id_curr", "sk_id_prev")),
    "pos_cash_balance": CleanConfig(("sk_id_curr", "sk_id_prev")),
    "credit_card_balance": CleanConfig(("sk_id_curr", "sk_id_prev")),
    "installments_payments": CleanConfig(("sk_id_curr", "sk_id_prev")),
}


def clean_table(df: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """Names, sentinels, sparse columns, then sparse rows of what remains."""
    named = null_sentinel(normalize_columns(df), config.sentinel_columns)
    dense = drop_sparse_columns(named, config.column_threshold, config.protected)
    return drop_sparse_rows(dense, config.row_threshold)
