"""Shares, latest rows, ranking, stacking and pivots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import rank_of
from creditloom.operators.entity import Metric


def with_share(counts: DataFrame, count: str = "n", name: str = "pct", digits: int | None = None) -> DataFrame:
    """Percentage of the column total. The total is a scalar subquery over the
    same counts; Spark reuses their exchange, so the source is read once and
    nothing is gathered in a single window partition."""
    total = counts.agg(F.sum(count)).scalar()
    pct = F.col(count) * F.lit(100.0) / total
    return counts.withColumn(name, F.round(pct, digits) if digits is not None else pct)


def share_of_total(
    df: DataFrame,
    group: str | Sequence[str] | dict[str, Column],
    count: str = "n",
    name: str = "pct",
    digits: int | None = None,
    extra: Sequence[Metric] = (),
) -> DataFrame:
    """Rows per group with their percentage of all rows and further metrics."""
    if isinstance(group, dict):
        keys = [c.alias(k) for k, c in group.items()]
    else:
        keys = [group] if isinstance(group, str) else list(group)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *[m.column() for m in extra])
    return with_share(counts, count, name, digits)


def latest_per(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], tie: str | Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest ``order`` (nulls last), ties broken by ``tie``.

    An aggregate of structs instead of a ranked window: it combines before the
    shuffle and never sorts all rows of a key in one task.
    """
    by = [*([order] if isinstance(order, str) else order), *([tie] if isinstance(tie, str) else tie)]
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    pick = F.max_by(F.struct(*cols), F.struct(*by)).alias("_row")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])


def order_by_rank(df: DataFrame, label: str, order: Sequence[str], *then: str) -> DataFrame:
    return df.orderBy(rank_of(label, order), *then)


def top_k(df: DataFrame, column: str | Column, k: int, *tie: str, ascending: bool = False) -> DataFrame:
    """First ``k`` rows by a column; ``tie`` columns make the cut stable."""
    c = F.col(column) if isinstance(column, str) else column
    first = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    return df.orderBy(first, *tie).limit(k)


def stack_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


def to_long(
    df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (), as_type: str | None = None,
    name: str = "variable", value: str = "value",
) -> DataFrame:
    """Wide to long, one scan; ``as_type`` casts the values to a common type."""
    wide = df.select(*ids, *[F.col(c).cast(as_type).alias(c) if as_type else F.col(c) for c in cols])
    return wide.unpivot(list(ids), list(cols), name, value)


def pivot_counts(
    df: DataFrame, row: str, column: str, values: Sequence, value: Column | None = None, names: Sequence[str] | None = None
) -> DataFrame:
    """Counts (or sums of ``value``) of the listed column values, 0 if absent."""
    names = list(names or [f"{column}_{v}" for v in values])
    cells = []
    for v, n in zip(values, names):
        hit = F.col(column) == F.lit(v)
        cell = F.count_if(hit) if value is None else F.coalesce(F.sum(F.when(hit, value)), F.lit(0))
        cells.append(cell.alias(n))
    return df.groupBy(row).agg(*cells)


def pivot_rate(
    df: DataFrame, row: str, column: str = "target", value: Column | None = None,
    negative: str = "negatives", positive: str = "positives", rate: str = "rate_pct",
) -> DataFrame:
    """Label 0/1 counts as columns and the percentage of label 1."""
    wide = pivot_counts(df, row, column, [0, 1], value, [negative, positive])
    return wide.withColumn(rate, F.try_divide(F.col(positive) * F.lit(100.0), F.col(negative) + F.col(positive)))


def confusion_pivot(report: DataFrame) -> DataFrame:
    """Share within the true class: a row per true class, a column per
    predicted class."""
    share = F.col("pct_of_true_class")
    return report.groupBy("true_class").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("predicted_class") == c, share)), F.lit(0.0)).alias(n)
            for c, n in (("predicted no default", "predicted_no_default"), ("predicted default", "predicted_default"))
        ]
    )
