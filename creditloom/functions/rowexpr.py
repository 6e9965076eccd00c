"""Row-wise feature expressions (built-in Spark functions only).

Literals are doubles throughout: ``365.0`` inside SQL text would be a DECIMAL
and change result types.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(
    num: ColumnOrName,
    den: ColumnOrName,
    guard: str = "nonzero",
    offset: float = 0.0,
    den_default: float | None = None,
) -> Column:
    """``num / (den + offset)`` as double, null where the division is unsafe.

    ``guard="nonzero"`` nulls a zero denominator, ``guard="positive"`` anything
    not above zero. ``den_default`` replaces a null denominator first.
    """
    d = as_col(den).cast("double")
    if den_default is not None:
        d = F.coalesce(d, F.lit(float(den_default)))
    if offset:
        d = d + F.lit(float(offset))
    n = as_col(num).cast("double")
    if guard == "nonzero":
        return F.try_divide(n, d)
    if guard == "positive":
        return F.when(d > 0, n / d)
    raise ValueError(f"unknown guard: {guard}")


def clip(c: ColumnOrName, lo: float | None = None, hi: float | None = None, null_safe: bool = False) -> Column:
    """Bound a value. SQL ``least``/``greatest`` skip nulls, so by default a
    null becomes the bound; ``null_safe=True`` keeps it null (recommended)."""
    c = as_col(c)
    out = c
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(c.isNotNull(), out) if null_safe else out


def positive_part(c: ColumnOrName, null_safe: bool = False) -> Column:
    """``max(c, 0)``, e.g. days past due out of a signed delay."""
    c = as_col(c)
    out = F.greatest(c, F.lit(0).cast("double"))
    return F.when(c.isNotNull(), out) if null_safe else out


def flag(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def keep_if(c: ColumnOrName, cond: Column) -> Column:
    return F.when(cond, as_col(c))


def map_values(c: ColumnOrName, mapping: Mapping, default: object = None) -> Column:
    """Replace known values; everything else becomes ``default``."""
    c = as_col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def status_number(c: ColumnOrName, digits: Sequence[str] = ("0", "1", "2", "3", "4", "5")) -> Column:
    """Numeric level of a status code; letters and unknown codes give null."""
    c = as_col(c)
    return F.when(c.isin(list(digits)), c.try_cast("int"))


def days_to_years(c: ColumnOrName, sign: str = "abs") -> Column:
    """Signed day offset to years: absolute value or sign-flipped."""
    d = as_col(c).cast("double")
    if sign == "abs":
        d = F.abs(d)
    elif sign == "neg":
        d = -d
    elif sign != "keep":
        raise ValueError(f"unknown sign: {sign}")
    return d / F.lit(365.0)


def log_amount(c: ColumnOrName) -> Column:
    return F.log1p(as_col(c).cast("double"))


def row_sum(cols: Sequence[str]) -> Column:
    """Sum across columns, nulls count as zero."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def row_count_flags(cols: Sequence[str]) -> Column:
    """Number of raised indicators; each is bounded to [0, 1] first."""
    return reduce(
        add,
        [F.least(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)), F.lit(1)) for c in cols],
    )


def row_stats(cols: Sequence[str], prefix: str) -> dict[str, Column]:
    """Mean, min, max and sample deviation across columns, ignoring nulls.

    ``least``/``greatest`` skip nulls by definition, so no arrays are built and
    the expressions stay inside generated code.
    """
    values = [F.col(c).cast("double") for c in cols]
    n = reduce(add, [v.isNotNull().cast("int") for v in values])
    total = reduce(add, [F.coalesce(v, F.lit(0.0)) for v in values])
    squares = reduce(add, [F.coalesce(v * v, F.lit(0.0)) for v in values])
    variance = (squares - total * total / n) / (n - 1)
    single = len(values) == 1
    return {
        f"{prefix}_mean": F.when(n > 0, total / n),
        f"{prefix}_min": values[0] if single else F.least(*values),
        f"{prefix}_max": values[0] if single else F.greatest(*values),
        f"{prefix}_std": F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))),
    }


@dataclass(frozen=True)
class Buckets:
    """Ordered bins with labels.

    ``edges`` are inclusive upper bounds; ``labels`` has one entry more for the
    rest. ``zero_label`` catches an exact zero before the edges; a null takes
    ``null_label`` or, without one, the label of the rest.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    null_label: str | None = None
    zero_label: str | None = None

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("one label per edge plus one for the rest")

    @property
    def order(self) -> list[str]:
        head = [self.zero_label] if self.zero_label is not None else []
        tail = [self.null_label] if self.null_label is not None else []
        return head + list(self.labels) + tail

    def label(self, c: ColumnOrName) -> Column:
        c = as_col(c)
        out = F.when(c.isNull(), F.lit(self.null_label if self.null_label is not None else self.labels[-1]))
        if self.zero_label is not None:
            out = out.when(c == 0, F.lit(self.zero_label))
        for edge, label in zip(self.edges, self.labels):
            out = out.when(c <= F.lit(edge), F.lit(label))
        return out.otherwise(F.lit(self.labels[-1]))

    def rank(self, label: ColumnOrName) -> Column:
        return rank_of(label, self.order)


def bucketize(c: ColumnOrName, edges, labels, null_label=None, zero_label=None) -> Column:
    return Buckets(tuple(edges), tuple(labels), null_label, zero_label).label(c)


def rank_of(label: ColumnOrName, order: Sequence[str]) -> Column:
    """Explicit sort rank of a label; unlisted labels come last."""
    return map_values(label, {name: i for i, name in enumerate(order)}, default=len(order))


# Artifact type is the first entry with a word contained in the
# lower-cased key.
ARTIFACT_WORDS: list[tuple[str, list[str]]] = [
    ("model_predictions", ["predictions", "prediction", "scored", "inference"]),
    ("model_metrics", ["metrics", "metric", "evaluation", "auc", "roc", "confusion"]),
    ("feature_selection", ["importance", "feature_selection", "binary_rank", "continuous_rank"]),
    ("refined_data", ["train_final_features", "train_features_selected", "refined", "features"]),
]


def artifact_type(key: ColumnOrName) -> Column:
    k = F.lower(as_col(key))
    out = None
    for name, words in ARTIFACT_WORDS:
        cond = k.rlike("|".join(words))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit("other"))


def positive_probability(df: DataFrame, column: str = "probability") -> Column:
    """Second entry of a probability column: ML vector, array or text."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.ArrayType):
        return F.get(F.col(column), F.lit(1)).cast("double")
    if isinstance(dtype, T.StringType):
        parts = F.split(F.regexp_replace(F.col(column), r"[\[\]\s]", ""), ",")
        return F.get(parts, F.lit(1)).try_cast("double")
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(F.col(column)), F.lit(1))
