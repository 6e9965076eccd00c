"""Vectors, forest, scoring, feature ranking and evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.rowexpr import map_values
from creditloom.operators.cleaning import apply_fill, fit_median, numeric_columns
from creditloom.operators.entity import corr_with
from creditloom.operators.profiling import per_column
from creditloom.shared import shared_folder

ID_COLUMNS = ("sk_id_curr", "sk_id_prev", "sk_id_bureau")


def feature_columns(df: DataFrame, label: str = "target", exclude: Sequence[str] = ID_COLUMNS) -> list[str]:
    return numeric_columns(df, {*exclude, label, "label", "class_weight"})


def assemble(df: DataFrame, cols: Sequence[str], on_null: str = "median", name: str = "features",
             train: DataFrame | None = None) -> DataFrame:
    """Numeric columns to one vector. Nulls become the column median (learned
    from ``train`` when given), zero, or NaN with ``keep``."""
    if on_null == "median":
        df = apply_fill(df, fit_median(train if train is not None else df, cols))
        df = df.fillna(0, subset=list(cols))  # a column without any value has no median
    elif on_null == "zero":
        df = df.fillna(0, subset=list(cols))
    elif on_null != "keep":
        raise ValueError(f"unknown on_null: {on_null}")
    return VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid="keep").transform(df)


@dataclass(frozen=True)
class ForestParams:
    """The full model's settings; ``BASELINE`` is the quick one."""

    trees: int = 50
    depth: int = 8
    subset: str = "sqrt"
    subsampling: float = 0.8
    seed: int = 42


BASELINE = ForestParams(trees=20, depth=3, subset="auto", subsampling=1.0)


#: Levels of the trees between two checkpoints of the rows' node numbers.
CHECKPOINT_LEVELS = 4
#: Partitions of the training rows, a fixed number, so that samples don't depend on the cluster.
TRAINING_PARTS = 32


def fit_forest(
    train: DataFrame, params: ForestParams = ForestParams(), label: str = "label", weight: str | None = None,
    key: str | None = None, parts: int = TRAINING_PARTS, memory_mb: int = 512,
) -> RandomForestClassificationModel:
    """Train on ``features``. Deep forests keep the node each row has reached
    instead of walking every tree again for each level, and write these numbers
    to the shared folder every few levels, so a lost executor costs at most
    those. Bootstrap samples hang on the partition and order of a row: with
    ``key`` rows are dealt and sorted by it, and training repeats exactly on any
    cluster. ``memory_mb`` bounds the statistics of the nodes split in one pass.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(train.sparkSession)}/_checkpoints")
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        numTrees=params.trees,
        maxDepth=params.depth,
        featureSubsetStrategy=params.subset,
        subsamplingRate=params.subsampling,
        seed=params.seed,
        cacheNodeIds=True,
        checkpointInterval=CHECKPOINT_LEVELS,
        maxMemoryInMB=memory_mb,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    if key is not None:
        kept = [key, label, "features", *([weight] if weight else [])]
        train = train.select(*kept).repartition(parts, key).sortWithinPartitions(key)
    # a copy has no training summary: that one holds the session, which does not
    # travel to the executors once a frame of it has been observed
    return forest.fit(train).copy()


def score(model: RandomForestClassificationModel, df: DataFrame, keep: Sequence[str] = ("sk_id_curr", "target", "label")) -> DataFrame:
    kept = [c for c in keep if c in df.columns]
    return model.transform(df).select(*kept, "prediction", "probability")


def importance(model: RandomForestClassificationModel, cols: Sequence[str], df: DataFrame) -> DataFrame:
    """One row per feature, most important first (ties by name)."""
    rows = [(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def binary_features(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with values inside [0, 1] and at most two of them. Two bounded
    passes (range, then values strictly between) instead of a distinct set per
    column, which would multiply the rows by the number of columns."""
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    row = df.agg(*[F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias(f"r{i}") for i, v in enumerate(values.values())]).first()
    bounds = {c: row[f"r{i}"] for i, c in enumerate(cols)}
    inside = [c for c, b in bounds.items() if b["lo"] is not None and b["lo"] >= 0 and b["hi"] <= 1]
    if not inside:
        return []
    mid = df.agg(
        *[
            F.count_if((values[c] > F.lit(bounds[c]["lo"])) & (values[c] < F.lit(bounds[c]["hi"]))).alias(f"m{i}")
            for i, c in enumerate(inside)
        ]
    ).first()
    return [c for i, c in enumerate(inside) if mid[f"m{i}"] == 0]


def chi_square_table(df: DataFrame, cols: Sequence[str], label: str = "target") -> DataFrame:
    """Chi-square statistic of independence between each two-valued feature and
    a 0/1 label, from one aggregate; nulls count as zero. A feature or label
    with a single value has statistic 0."""
    y = F.col(label).cast("int") == 1

    def fields(c: str) -> dict[str, Column]:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) > 0
        n = F.count(F.lit(1)).cast("double")
        a, b = F.count_if(x & y).cast("double"), F.count_if(x & ~y).cast("double")
        c_, d = F.count_if(~x & y).cast("double"), F.count_if(~x & ~y).cast("double")
        cross = a * d - b * c_
        margins = (a + b) * (c_ + d) * (a + c_) * (b + d)
        return {"statistic": F.coalesce(F.try_divide(n * cross * cross, margins), F.lit(0.0))}

    return per_column(df, cols, fields).withColumnRenamed("variable", "feature")


def chi_square_tail(statistic: Column) -> tuple[Column, Column]:
    """Probability of a larger statistic with one degree of freedom, and its
    negative decimal logarithm.

    The tail is erfc(sqrt(x / 2)), as a rational argument to a polynomial in the
    exponent (relative error below 1.2e-7), so the logarithm stays finite where
    the probability no longer has digits.
    """
    z = F.sqrt(statistic / 2)
    t = F.lit(1.0) / (F.lit(1.0) + z / 2)
    # Coefficients of the Chebyshev fit, lowest power first.
    fit = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    power = F.lit(fit[-1])
    for c in reversed(fit[:-1]):
        power = power * t + F.lit(c)
    exponent = F.ln(t) + power - z * z
    return F.least(F.exp(exponent), F.lit(1.0)), F.greatest(-exponent / F.ln(F.lit(10.0)), F.lit(0.0))


def rank_features(df: DataFrame, label: str = "target", exclude: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """One row per feature: ``feature, kind, strength, value, p_value, neg_log10_p``.

    ``continuous`` features have their Pearson correlation with the label as
    value and its size as strength; ``binary`` ones the chi-square statistic as
    both, with its p-value. Nulls count as zero.
    """
    cols = feature_columns(df, label, exclude)
    work = df.select(label, *cols).fillna(0, subset=cols)
    binary = binary_features(work, cols)
    continuous = [c for c in cols if c not in binary]
    parts = []
    if continuous:
        none = F.lit(None).cast("double")
        pearson = corr_with(work, label, continuous)
        parts.append(
            pearson.select(
                F.col("variable").alias("feature"), F.lit("continuous").alias("kind"), F.col("abs_corr").alias("strength"),
                F.col("corr_target").alias("value"), none.alias("p_value"), none.alias("neg_log10_p"),
            )
        )
    if binary:
        p, digits = chi_square_tail(F.col("statistic"))
        tests = chi_square_table(work, binary, label)
        parts.append(
            tests.select(
                "feature", F.lit("binary").alias("kind"), F.col("statistic").alias("strength"),
                F.col("statistic").alias("value"), p.alias("p_value"), digits.alias("neg_log10_p"),
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "feature string, kind string, strength double, value double, p_value double, neg_log10_p double")
    ranked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return ranked.orderBy("kind", F.desc_nulls_last("strength"), "feature")


AUC_BUCKETS = 256


def auc_table(scored: DataFrame, label: str = "label", score_col: str = "probability", by: Sequence[str] = (),
              buckets: int = AUC_BUCKETS) -> DataFrame:
    """``by, positives, negatives, auc``: area under the ROC curve as the rank
    sum of the positives, ties at their middle rank; lazy, exact.

    Rows are counted per distinct score, the scores of a group are cut into
    buckets of about equal size, and running counts are taken inside a bucket.
    A bucket leaves its two totals and its share of the rank sum, which add up
    over the buckets in order: no task sorts all scores, and as everything comes
    from one assignment of scores to buckets, their limits need not be exact.
    A group with one class only has a null area, rows without label or score
    take no part, and without ``by`` there is one row whatever the input.
    """
    keys = list(by)
    y, s = F.col(label).cast("double"), F.col(score_col).cast("double")
    rows = scored.select(*keys, y.alias("_y"), s.alias("_s")).filter(F.col("_y").isin(0.0, 1.0) & F.col("_s").isNotNull())
    counts = rows.groupBy(*keys, "_s").agg(F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg"))
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    edges = counts.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.percentile_approx("_s", probs, 20 * buckets).alias("_edges"))
    if keys:
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        cut = counts.join(edges, same)
    else:
        cut = counts.withColumn("_edges", edges.select("_edges").scalar())
    bucket = F.size(F.filter("_edges", lambda e: e < F.col("_s")))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cut.select(*keys, "_s", "_pos", "_neg", bucket.alias("_bucket")).withColumn("_upto", F.sum("_neg").over(inside))
    won = F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2.0)
    parts = ranked.groupBy(*keys, "_bucket").agg(F.sum("_pos").alias("pos"), F.sum("_neg").alias("neg"), F.sum(won).alias("won"))
    ordered = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_bucket", "pos", "neg", "won"))).alias("_parts"))
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"), F.lit(0.0).alias("won"))

    def add(total: Column, part: Column) -> Column:
        return F.struct(
            (total["pos"] + part["pos"]).alias("pos"),
            (total["neg"] + part["neg"]).alias("neg"),
            (total["won"] + part["won"] + part["pos"] * total["neg"].cast("double")).alias("won"),
        )

    total = ordered.select(*keys, F.aggregate("_parts", start, add).alias("_t"))
    pairs = F.col("_t.pos").cast("double") * F.col("_t.neg")
    return total.select(*keys, F.col("_t.pos").alias("positives"), F.col("_t.neg").alias("negatives"), F.try_divide(F.col("_t.won"), pairs).alias("auc"))


def auc(scored: DataFrame, label: str = "label", score_col: str = "probability") -> float | None:
    """The value of ``auc_table`` without groups."""
    return auc_table(scored, label, score_col).first()["auc"]


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


# The four outcomes with label, prediction and readable classes.
OUTCOMES: list[tuple[str, int, int, str, str, str]] = [
    ("TP", 1, 1, "default", "predicted default", "defaults recognised"),
    ("TN", 0, 0, "no default", "predicted no default", "non-defaults recognised"),
    ("FP", 0, 1, "no default", "predicted default", "non-defaults marked as default"),
    ("FN", 1, 0, "default", "predicted no default", "defaults missed"),
]


def _counts(label: str, prediction: str) -> dict[str, Column]:
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return {name: F.count_if((y == yv) & (p == pv)) for name, yv, pv, *_ in OUTCOMES}


def confusion_report(pred: DataFrame, model: str = "RandomForestClassifier", label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """The four outcomes with count, percentage of all rows and percentage
    within the true class, from one aggregate."""
    one = pred.agg(*[c.alias(n) for n, c in _counts(label, prediction).items()])
    total = F.col("TP") + F.col("TN") + F.col("FP") + F.col("FN")
    class_size = {1: F.col("TP") + F.col("FN"), 0: F.col("TN") + F.col("FP")}
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(name).alias("outcome"),
            F.lit(true).alias("true_class"),
            F.lit(guess).alias("predicted_class"),
            F.col(name).alias("count"),
            F.coalesce(F.try_divide(F.col(name) * F.lit(100.0), total), F.lit(0.0)).alias("pct_of_total"),
            F.coalesce(F.try_divide(F.col(name) * F.lit(100.0), class_size[yv]), F.lit(0.0)).alias("pct_of_true_class"),
            F.lit(meaning).alias("meaning"),
        )
        for name, yv, _, true, guess, meaning in OUTCOMES
    ]
    return one.select(F.inline(F.array(*rows)))


METRIC_MEANINGS = {
    "accuracy": "share of all rows predicted correctly",
    "precision": "share of predicted defaults that are defaults",
    "recall": "share of defaults that were predicted",
    "f1_score": "balance of precision and recall",
    "auc": "ability to rank defaults above non-defaults",
}


def metrics(pred: DataFrame, model: str = "RandomForestClassifier", label: str = "label", prediction: str = "prediction",
            score_col: str | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 from one conditional aggregate, and
    AUC when a score column (a number or a probability vector) is given:
    ``model, metric, value, meaning``; lazy."""
    n = _counts(label, prediction)
    values: Mapping[str, Column] = {
        "accuracy": F.try_divide(n["TP"] + n["TN"], n["TP"] + n["TN"] + n["FP"] + n["FN"]),
        "precision": F.try_divide(n["TP"], n["TP"] + n["FP"]),
        "recall": F.try_divide(n["TP"], n["TP"] + n["FN"]),
        "f1_score": F.try_divide(n["TP"] * F.lit(2.0), n["TP"] * 2 + n["FP"] + n["FN"]),
    }
    parts = {k: v.cast("double") for k, v in values.items()}
    if score_col:
        # a score may be a probability vector; the area needs the one number
        plain = isinstance(pred.schema[score_col].dataType, T.NumericType)
        p = F.col(score_col) if plain else F.get(vector_to_array(score_col), F.lit(1))
        scores = pred.select(F.col(label).alias("_label"), p.alias("_score"))
        parts["auc"] = auc_table(scores, "_label", "_score").select("auc").scalar()
    rows = [
        F.struct(F.lit(model).alias("model"), F.lit(k).alias("metric"), v.alias("value"), F.lit(METRIC_MEANINGS[k]).alias("meaning"))
        for k, v in parts.items()
    ]
    return pred.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def actual_vs_predicted(pred: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """Counts by readable actual and predicted class."""
    def readable(c: str, what: str) -> Column:
        value = F.col(c).cast("double")
        return map_values(value, {0.0: f"{what}: no default", 1.0: f"{what}: default"}, f"{what}: other")

    return pred.groupBy(
        readable(label, "actual").alias("actual"), readable(prediction, "predicted").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("count"))
