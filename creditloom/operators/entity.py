"""Declarative aggregation of satellite rows to one row per entity.

All metrics of a block share one ``groupBy``: partial aggregation runs before
the only shuffle, so a key holding a large share of the rows reaches its final
task as one partial row per upstream task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.quantiles import SKETCH_ACCURACY, q_approx
from creditloom.functions.rowexpr import ColumnOrName, as_col

KINDS = (
    "count", "sum", "sum0", "avg", "min", "max", "count_distinct", "share", "pct", "any", "first", "mode", "quantile"
)


@dataclass(frozen=True)
class Metric:
    """One output column.

    kind      count / sum / sum0 (null-safe) / avg / min / max / count_distinct /
              share (0..1 of rows where the condition holds) / pct (0..100) /
              any (0/1) / first (by ``order``) / mode / quantile
    value     the measured column or expression
    where     condition restricting the rows the metric sees
    digits    rounding, ``None`` for none
    """

    name: str
    kind: str
    value: ColumnOrName | None = None
    where: Column | None = None
    digits: int | None = None
    q: float = 0.5
    accuracy: int = SKETCH_ACCURACY
    order: ColumnOrName | None = None

    def column(self) -> Column:
        return metric_column(self)


def metric_column(m: Metric) -> Column:
    if m.kind not in KINDS:
        raise ValueError(f"unknown metric kind: {m.kind}")
    if m.kind in ("share", "pct", "any"):
        hit = F.when(m.where, F.lit(1)).otherwise(F.lit(0))
        out = F.max(hit) if m.kind == "any" else F.avg(hit)
        if m.kind == "pct":
            out = F.count_if(m.where) * F.lit(100.0) / F.count(F.lit(1))
    elif m.kind == "count" and m.value is None:
        out = F.count(F.lit(1)) if m.where is None else F.count_if(m.where)
    else:
        value = as_col(m.value)
        if m.where is not None:
            value = F.when(m.where, value)
        if m.kind == "sum0":
            out = F.sum(F.coalesce(value, F.lit(0)))
        elif m.kind == "first":
            if m.order is None:
                raise ValueError(f"{m.name}: 'first' needs an order column")
            out = F.min_by(value, as_col(m.order))
        elif m.kind == "mode":
            out = mode_of(value)
        elif m.kind == "quantile":
            out = q_approx(value, m.q, m.accuracy)
        else:
            out = {
                "count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max,
                "count_distinct": F.count_distinct,
            }[m.kind](value)
    if m.digits is not None:
        out = F.round(out, m.digits)
    return out.alias(m.name)


def mode_of(c: ColumnOrName) -> Column:
    """Most frequent value, ties to the lowest. The buffer grows with the
    number of different values, so keep it to categories."""
    return F.mode(as_col(c), True)


def entity_aggregate(df: DataFrame, key: str | Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    names = [m.name for m in metrics]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate metric names: {sorted(n for n in names if names.count(n) > 1)}")
    return df.groupBy(*keys).agg(*[m.column() for m in metrics])


def global_aggregate(df: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    return df.agg(*[m.column() for m in metrics])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Aggregate: Pearson correlation, null when a side is constant (the
    built-in divides by zero there under ANSI rules)."""
    a, b = as_col(x).cast("double"), as_col(y).cast("double")
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def corr_with(df: DataFrame, label: str, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pearson correlation of every column with the label: ``variable,
    corr_target, abs_corr``; one aggregate over one scan."""
    rows = []
    for c in cols:
        r = safe_corr(label, c)
        rows.append(F.struct(F.lit(c).alias("variable"), (F.round(r, digits) if digits is not None else r).alias("corr_target")))
    return (
        df.agg(F.array(*rows).alias("rows"))
        .select(F.inline("rows"))
        .withColumn("abs_corr", F.abs("corr_target"))
    )
