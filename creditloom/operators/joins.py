"""Joins of aggregates, labels and snapshots to entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.cleaning import ensure_columns

MAX_HOT_KEYS = 1_000


def attach(base: DataFrame, agg: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of one aggregate that is unique on the key(s)."""
    keys = [key] if isinstance(key, str) else list(key)
    clash = sorted((set(base.columns) & set(agg.columns)) - set(keys))
    if clash:
        raise ValueError(f"both sides have: {clash}")
    return base.join(agg, keys, "left")


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest row by column order: unlike an arbitrary
    pick it does not change when a task is recomputed."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    row = F.min(F.struct(*rest)).alias("_row")
    return df.groupBy(key).agg(row).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def assemble_master(
    base: DataFrame,
    aggregates: Mapping[str, DataFrame | None],
    key: str,
    expected: Mapping[str, Mapping[str, str]] | None = None,
    dedupe: Sequence[str] = (),
) -> DataFrame:
    """Left-join a chain of aggregates on one key; the base rows are preserved.

    Aggregates come out of ``groupBy(key)`` and are unique; names listed in
    ``dedupe`` are reduced to one row per key first. A missing source (``None``)
    contributes the typed null columns declared for it in ``expected``, which
    equals joining an empty aggregate but costs nothing. The base label wins
    over a label inside an aggregate.
    """
    master = base
    for name, agg in aggregates.items():
        if agg is None:
            master = ensure_columns(master, (expected or {}).get(name, {}))
            continue
        if name in dedupe:
            agg = unique_by(agg, key)
        clash = [c for c in agg.columns if c != key and c in master.columns]
        master = attach(master, agg.drop(*clash), key)
    return master


def bridge_join(snapshots: DataFrame, credits: DataFrame, snapshot_key: str, entity_key: str) -> DataFrame:
    """Snapshot rows with the entity that owns their credit.

    Only the two key columns of ``credits`` take part. Pass snapshots that are
    already counted per credit (see ``count_rows``): then a credit with very
    many snapshots is a handful of rows when it meets the join.
    """
    return snapshots.join(credits.select(snapshot_key, entity_key), snapshot_key, "inner")


def count_rows(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    """Collapse equal rows into one with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def hot_keys(df: DataFrame, key: str, parts: int = MAX_HOT_KEYS) -> list:
    """Keys holding more than ``1/parts`` of the rows: fewer than ``parts``."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.agg(F.sum("n")).scalar() / F.lit(float(parts))
    return [r[key] for r in counts.filter((F.col("n") > limit) & F.col(key).isNotNull()).select(key).collect()]


def skew_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner", parts: int = MAX_HOT_KEYS) -> DataFrame:
    """Join facts to a lookup that is unique on the key when some keys are hot.

    The rows of hot keys meet their lookup rows by broadcast (there are fewer
    than ``parts`` of them by construction) and stay where they are; all other
    rows shuffle. Use it where facts cannot be aggregated before the join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    hot = hot_keys(facts, key, parts)
    if not hot:
        return facts.join(lookup, key, how)
    is_hot = F.col(key).isin(hot)
    warm = facts.filter(is_hot).join(F.broadcast(lookup.filter(is_hot)), key, how)
    cold = facts.filter(~is_hot | F.col(key).isNull()).join(lookup.filter(~is_hot), key, how)
    return warm.unionByName(cold)
