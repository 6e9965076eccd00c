"""Learned caps, encodings, splits, samples and class weights."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.naming import value_columns
from creditloom.functions.quantiles import SKETCH_ACCURACY, distinct_estimate, exact_quantiles
from creditloom.functions.rowexpr import flag
from creditloom.operators.cleaning import fit_median, numeric_columns, string_columns
from creditloom.operators.shaping import to_long
from creditloom.shared import materialize

MAX_LITERAL_VALUES = 200
#: Values of one column that may become columns.
MAX_VALUE_COLUMNS = 5_000
MAX_BROADCAST_VALUES = 100_000


@dataclass(frozen=True)
class Caps:
    """Learned upper bound per column; a column without values has none."""

    bounds: dict[str, float] = field(default_factory=dict)

    def capped(self, name: str, value: Column | None = None, dtype: T.DataType = T.DoubleType()) -> Column:
        c = F.col(name) if value is None else value
        bound = self.bounds.get(name)
        if bound is None:
            return c
        # least() alone would turn a null into the bound
        limit = F.lit(bound).cast(dtype)
        return F.when(c > limit, limit).otherwise(c)


def fit_caps(df: DataFrame, probs: Mapping[str, float | tuple[Column, float]], method: str = "approx",
             accuracy: int = SKETCH_ACCURACY) -> Caps:
    """Upper quantiles of all columns in one pass. A probability may come with
    an expression, ``{name: (expression, q)}``, to cap a derived value."""
    if not probs:
        return Caps()
    exprs = {n: (p if isinstance(p, tuple) else (F.col(n), p)) for n, p in probs.items()}
    if method == "exact":
        wide = df.select(*[e.alias(n) for n, (e, _) in exprs.items()])
        wanted = exact_quantiles(wide, list(exprs), sorted({q for _, q in exprs.values()}))
        rows = wanted.collect()
        return Caps({r["variable"]: r["value"] for r in rows if exprs[r["variable"]][1] == r["q"]})
    row = df.agg(
        *[F.percentile_approx(e, q, accuracy).alias(f"c{i}") for i, (e, q) in enumerate(exprs.values())]
    ).first()
    return Caps({n: float(row[f"c{i}"]) for i, n in enumerate(exprs) if row[f"c{i}"] is not None})


def apply_caps(df: DataFrame, caps: Caps, suffix: str = "_cap") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": caps.capped(c, dtype=df.schema[c].dataType) for c in caps.bounds})


def fit_values(df: DataFrame, cols: Sequence[str], limit: int = MAX_VALUE_COLUMNS) -> dict[str, list[str]]:
    """Non-null values of every column from one scan, sorted.

    The result becomes columns and is held by the driver, so a column of more
    than ``limit`` values raises; nothing is cut off. ``frequent_values`` finds
    those of such a column that are worth a column, ``long_shares`` needs none.
    """
    if not cols:
        return {}
    distinct = to_long(df, cols, as_type="string").filter(F.col("value").isNotNull()).distinct()
    rows = distinct.limit(limit * len(cols) + 1).collect()
    values: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        values[r["variable"]].append(r["value"])
    wide = [c for c, v in values.items() if len(v) > limit]
    if wide or len(rows) > limit * len(cols):
        raise ValueError(f"more than {limit} values, use frequent values or a label index instead: {wide or cols}")
    return {c: sorted(v) for c, v in values.items()}


@dataclass(frozen=True)
class OneHotModel:
    """Indicator name per column and value."""

    names: dict[str, dict[str, str]]
    null_names: dict[str, str]

    @property
    def columns(self) -> list[str]:
        return [n for c in self.names for n in [*self.names[c].values(), *([self.null_names[c]] if c in self.null_names else [])]]


def fit_one_hot(df: DataFrame, cols: Sequence[str], null_indicator: bool = True,
                limit: int = MAX_VALUE_COLUMNS, values: Mapping[str, Sequence[str]] | None = None) -> OneHotModel:
    found = values if values is not None else fit_values(df, cols, limit)
    taken = {c for c in df.columns if c not in cols}
    nulls = {c: f"{c}_nan" for c in cols} if null_indicator else {}
    taken |= set(nulls.values())
    return OneHotModel({c: value_columns(c, found[c], taken) for c in cols}, nulls)


def apply_one_hot(df: DataFrame, model: OneHotModel, drop: bool = True) -> DataFrame:
    new: dict[str, Column] = {}
    for c, names in model.names.items():
        for value, name in names.items():
            new[name] = flag(F.col(c).cast("string") == F.lit(value))
        if c in model.null_names:
            new[model.null_names[c]] = flag(F.col(c).isNull())
    out = df.withColumns(new) if new else df
    return out.drop(*model.names) if drop else out


def category_shares(df: DataFrame, key: str, cols: Sequence[str], values: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Per entity, the share of its rows holding each value (a null row counts
    in the denominator). Values of all columns are found in one pass."""
    found = values if values is not None else fit_values(df, cols)
    taken = {key}
    shares = []
    for c in cols:
        for value, name in value_columns(c, found[c], taken).items():
            shares.append(F.avg(F.when(F.col(c) == F.lit(value), F.lit(1.0)).otherwise(F.lit(0.0))).alias(name))
    return df.groupBy(key).agg(*shares)


def long_shares(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``category_shares`` as rows ``key, variable, value, share``: no column
    per value, so their number does not matter. Values that an entity does not
    have make no row; nulls count in the denominator only."""
    rows = to_long(df, cols, [key], "string").groupBy(key, "variable", "value").agg(F.count(F.lit(1)).alias("_n"))
    totals = rows.groupBy(F.col(key).alias("_key"), F.col("variable").alias("_variable")).agg(F.sum("_n").alias("_total"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("variable") == F.col("_variable"))
    shares = rows.filter(F.col("value").isNotNull()).join(totals, same)
    return shares.select(key, "variable", "value", (F.col("_n") / F.col("_total")).alias("share"))


#: Items that a heavy-hitter sketch tracks, as a multiple of those that can reach the share.
TRACKED = 64


def frequent_values(df: DataFrame, cols: Sequence[str], share: float = 0.01) -> dict[str, dict[str, int]]:
    """Values that at least ``share`` of all rows have, with their exact counts.

    Two passes whatever the number of values: one heavy-hitter sketch per column
    proposes at most ``4 / share`` candidates, whose rows are then counted. The
    sketch errs by less than a tenth of ``share``, so no value that reaches it
    is missed, and the count removes those that don't. The driver holds at most
    ``4 / share`` rows per column.
    """
    if not 0 < share <= 1:
        raise ValueError(f"not a share: {share}")
    if not cols:
        return {}
    most = math.ceil(4 / share)
    tracked = min(math.ceil(TRACKED / share), 1_000_000)
    if tracked < 40 / share:
        raise ValueError(f"too small a share for the sketch: {share}")
    tops = [F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {most}, {tracked})").alias(f"t{i}") for i, c in enumerate(cols)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *tops).first()
    found = [(c, x["item"]) for i, c in enumerate(cols) for x in row[f"t{i}"] or [] if x["item"] is not None]
    if not found:
        return {c: {} for c in cols}
    wanted = df.sparkSession.createDataFrame(found, "variable string, value string")
    counts = to_long(df, cols, as_type="string").join(F.broadcast(wanted), ["variable", "value"]).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    out: dict[str, dict[str, int]] = {c: {} for c in cols}
    for r in sorted(counts.collect(), key=lambda r: r["value"]):
        if r["n"] >= share * row["rows"]:
            out[r["variable"]][r["value"]] = r["n"]
    return out


def split_shares(df: DataFrame, key: str, cols: Sequence[str], share: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """``category_shares`` of columns of any number of values, in two frames: a
    column per frequent value, and rows ``key, variable, value, share`` of all
    others. Together they hold every share, whatever the number of values."""
    frequent = frequent_values(df, cols, share)
    wide = category_shares(df, key, cols, {c: list(v) for c, v in frequent.items()})
    held = [(c, v) for c, values in frequent.items() for v in values]
    rest = long_shares(df, key, cols)
    if held:
        table = F.broadcast(df.sparkSession.createDataFrame(held, "variable string, value string"))
        rest = rest.join(table, ["variable", "value"], "left_anti")
    return wide, rest.select(key, "variable", "value", "share")


@dataclass(frozen=True)
class LabelIndex:
    """Alphabetical position of each value of a column.

    Few values are kept as literals. Many stay in a table of (value, index)
    that joins back; it is broadcast only when its counted size is small.
    """

    column: str
    literal: dict[str, float] | None
    table: DataFrame | None
    size: int
    null_index: float | None


def fit_label_index(df: DataFrame, column: str, literal_limit: int = MAX_LITERAL_VALUES) -> LabelIndex:
    """Null takes the next index after the last value when the column holds a
    null while fitting, and stays null otherwise."""
    values = df.select(F.col(column)).distinct()
    head = values.limit(literal_limit + 2).collect()
    if len(head) <= literal_limit + 1:
        found = sorted(r[0] for r in head if r[0] is not None)
        null_seen = any(r[0] is None for r in head)
        return LabelIndex(
            column, {v: float(i) for i, v in enumerate(found)}, None, len(found), float(len(found)) if null_seen else None
        )
    table, size = _numbered(values.filter(F.col(column).isNotNull()), column)
    null_seen = bool(df.filter(F.col(column).isNull()).limit(1).count())
    return LabelIndex(column, None, table, size, float(size) if null_seen else None)


def _numbered(values: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Positions 0.. of sorted distinct values without sorting in one task: the
    sorted rows are stored once, each knows its partition and its place in it,
    and the partition sizes (one row per partition) give the offsets."""
    placed = values.orderBy(column).select(
        column, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")
    )
    stored = materialize(placed)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
    # one row per partition of the sort
    starts = sizes.select(
        F.col("_part"), "first", "n", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("start")
    )
    table = stored.join(F.broadcast(starts), "_part").select(
        column, (F.col("start") + F.col("_id") - F.col("first")).cast("double").alias("_index")
    )
    return table, stored.count()


def apply_label_index(df: DataFrame, model: LabelIndex, suffix: str = "_idx", drop: bool = True) -> DataFrame:
    name, c = f"{model.column}{suffix}", F.col(model.column)
    null_value = F.lit(model.null_index).cast("double")
    if model.literal is not None:
        if model.literal:
            pairs = [F.lit(x) for kv in model.literal.items() for x in kv]
            known = F.try_element_at(F.create_map(*pairs), c)
        else:
            known = F.lit(None).cast("double")
        out = df.withColumn(name, F.when(c.isNull(), null_value).otherwise(known))
    else:
        table = F.broadcast(model.table) if model.size <= MAX_BROADCAST_VALUES else model.table
        out = df.join(table, model.column, "left").withColumn(
            name, F.when(c.isNull(), null_value).otherwise(F.col("_index"))
        ).drop("_index")
    return out.drop(model.column) if drop else out


@dataclass(frozen=True)
class EncoderModel:
    """What happens to each string column; also the encoder's metadata."""

    one_hot: OneHotModel
    indexes: tuple[LabelIndex, ...]
    cardinalities: dict[str, int]

    @property
    def one_hot_columns(self) -> list[str]:
        return list(self.one_hot.names)

    @property
    def index_columns(self) -> list[str]:
        return [i.column for i in self.indexes]


def fit_encoder(df: DataFrame, max_ohe: int = 12, exclude: Iterable[str] = ("sk_id_curr", "target")) -> EncoderModel:
    """String columns with at most ``max_ohe`` values become indicators, others
    a label index.

    A sketch sorts out clearly larger columns in one pass (its error at such
    small counts is far below the factor used); the rest is counted exactly
    through its values, which the indicators need anyway.
    """
    cols = string_columns(df, exclude)
    if not cols:
        return EncoderModel(OneHotModel({}, {}), (), {})
    row = df.agg(
        *[distinct_estimate(c).alias(f"d{i}") for i, c in enumerate(cols)],
        *[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)],
    ).first()
    estimate = {c: row[f"d{i}"] for i, c in enumerate(cols)}
    has_null = {c: row[f"z{i}"] > 0 for i, c in enumerate(cols)}
    near = [c for c in cols if estimate[c] <= 2 * max_ohe]
    values = fit_values(df, near) if near else {}
    few = [c for c in near if len(values[c]) <= max_ohe]
    many = [c for c in cols if c not in few]
    hot = fit_one_hot(df, few, values=values)
    hot = OneHotModel(hot.names, {c: n for c, n in hot.null_names.items() if has_null[c]})
    indexes = tuple(fit_label_index(df, c) for c in many)
    sizes = {c: len(values[c]) for c in few} | {i.column: i.size for i in indexes}
    return EncoderModel(hot, indexes, sizes)


def apply_encoder(df: DataFrame, model: EncoderModel) -> DataFrame:
    out = apply_one_hot(df, model.one_hot)
    for index in model.indexes:
        out = apply_label_index(out, index)
    return out


HASH_RANGE = 2**52


def unit_hash(key: str | Column, salt: str = "", method: str = "xxhash64") -> Column:
    """Deterministic number in [0, 1) of a key: the same on every run, however
    the rows are partitioned. ``md5`` is slower but portable to other engines."""
    text = F.concat(F.lit(salt), (F.col(key) if isinstance(key, str) else key).cast("string"))
    if method == "md5":
        number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    elif method == "xxhash64":
        number = F.xxhash64(text)
    else:
        raise ValueError(f"unknown method: {method}")
    return F.pmod(number, F.lit(HASH_RANGE)).cast("double") / F.lit(float(HASH_RANGE))


def hash_split(df: DataFrame, key: str, fraction: float = 0.8, salt: str = "", method: str = "xxhash64"):
    """Two disjoint frames that together hold every row (null keys go first)."""
    inside = F.coalesce(unit_hash(key, salt, method) < F.lit(fraction), F.lit(True))
    return df.filter(inside), df.filter(~inside)


def stratified_split(df: DataFrame, label: str, key: str, fraction: float = 0.8, salt: str = "",
                     method: str = "xxhash64", name: str = "in_train") -> DataFrame:
    """Mark rows so that every class is split at the same fraction.

    The threshold of a class is the exact quantile of the key hash inside it;
    ranking a class in one window would put whole classes into single tasks.
    Rows without a key are inside, as in ``hash_split``; a null label is a class.
    """
    hashed = df.withColumn("_u", unit_hash(key, salt, method))
    found = exact_quantiles(hashed, ["_u"], [fraction], [label])
    thresholds = found.select(F.col(label).alias("_class"), F.col("value").alias("_upto"))
    marked = hashed.join(thresholds, F.col(label).eqNullSafe(F.col("_class")), "left")
    return marked.withColumn(name, F.coalesce(F.col("_u") <= F.col("_upto"), F.lit(True))).drop("_u", "_class", "_upto")


def sample(df: DataFrame, key: str, fraction: float, seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """Rows whose hashed key lies below ``fraction``: without replacement, and
    the same however the rows are partitioned. Null keys are left out."""
    return df.filter(unit_hash(key, str(seed), method) < F.lit(fraction))


def fit_class_weights(df: DataFrame, label: str = "label") -> dict[float, float]:
    """``total / (classes * count)`` per class."""
    rows = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in rows)
    return {r[label]: total / (len(rows) * r["n"]) for r in rows}


def class_weights(df: DataFrame, label: str = "label", weights: Mapping[float, float] | None = None,
                  name: str = "class_weight") -> DataFrame:
    """Attach the class weight of each row; unknown classes weigh 1. Without
    learned ``weights`` the class counts are joined, whatever their number."""
    if weights is None:
        counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
        weight = F.lit(float(total["rows"] or 0)) / (F.lit(float(total["classes"] or 1)) * F.col("_n"))
        joined = df.join(counts, F.col(label) == F.col("_class"), "left")
        return joined.withColumn(name, F.coalesce(weight, F.lit(1.0))).drop("_class", "_n")
    learned = weights
    chain = F.lit(1.0)
    for value, weight in learned.items():
        chain = F.when(F.col(label) == F.lit(value), F.lit(float(weight))).otherwise(chain)
    return df.withColumn(name, chain)


def ml_pipeline(df: DataFrame, label: str = "target", ids: Sequence[str] = ("sk_id_curr", "sk_id_prev", "sk_id_bureau")):
    """Fit index + one-hot + median imputation + assembly.

    Returns the fitted pipeline and the prepared frame it applies to. One
    aggregate learns all medians and finds the numeric columns without any
    value, which are left out. With no feature left a constant one is used.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler

    skip = {*ids, label}
    cats = string_columns(df, skip)
    nums = numeric_columns(df, skip)
    prepared = df.fillna("Unknown", subset=cats) if cats else df
    if nums:
        prepared = prepared.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in nums})
        medians = fit_median(prepared, nums).values
        nums = [c for c in nums if c in medians]
    stages, features = [], []
    if nums:
        filled = ", ".join(f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {medians[c]!r}D) AS `{c}_imp`" for c in nums)
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
        features += [f"{c}_imp" for c in nums]
    if cats:
        indexed, hot = [f"{c}_idx" for c in cats], [f"{c}_ohe" for c in cats]
        stages.append(StringIndexer(inputCols=cats, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"))
        features += hot
    if not features:
        prepared = prepared.withColumn("const_feature", F.lit(1.0))
        features = ["const_feature"]
    stages.append(VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(prepared), prepared


def ml_ready(df: DataFrame, label: str = "target", key: str = "sk_id_curr", **options) -> DataFrame:
    """Key, label and feature vector."""
    model, prepared = ml_pipeline(df, label, **options)
    return model.transform(prepared).select(key, F.col(label).cast("double").alias("label"), "features")


def slot_names(df: DataFrame, vector: str = "features") -> dict[int, str]:
    """Name of each entry of an assembled vector, from the column's metadata."""
    attrs = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.values() for a in group}


def vector_entries(df: DataFrame, ids: Sequence[str], vector: str = "features", keep_zeros: bool = False) -> DataFrame:
    """``ids, slot, name, value``: one row per entry of a vector that is not 0.

    Sparse vectors give up their stored entries only, so a wide one-hot block
    costs a row per indicator that is set. ``keep_zeros`` gives every entry.
    """
    parts = F.unwrap_udt(vector)
    dense = F.transform(parts["values"], lambda x, i: F.struct(i.alias("slot"), x.alias("value")))
    stored = F.zip_with(parts["indices"], parts["values"], lambda i, x: F.struct(i.alias("slot"), x.alias("value")))
    if keep_zeros:
        from pyspark.ml.functions import vector_to_array

        entries = F.transform(vector_to_array(vector), lambda x, i: F.struct(i.alias("slot"), x.alias("value")))
    else:
        entries = F.filter(F.when(parts["type"] == 0, stored).otherwise(dense), lambda e: e["value"] != 0)
    rows = df.select(*ids, F.inline(entries))
    names = slot_names(df, vector)
    if not names:
        return rows.select(*ids, "slot", F.col("slot").cast("string").alias("name"), "value")
    # one literal array of names by slot: as long as the vector is wide
    named = F.array(*[F.lit(names.get(i, str(i))) for i in range(max(names) + 1)])
    return rows.select(*ids, "slot", F.coalesce(F.get(named, F.col("slot")), F.col("slot").cast("string")).alias("name"), "value")
