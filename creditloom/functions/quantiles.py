"""Approximate and exact quantiles that stay bounded per task.

``q_approx`` is a mergeable sketch of fixed size. ``exact_quantiles`` uses such
a sketch only to find a narrow interval around each wanted rank, counts what
lies below it and sorts just the distinct values inside, so even one group with
most of the rows never has to fit into a single buffer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import ColumnOrName, as_col
from creditloom.shared import materialize

SKETCH_ACCURACY = 10_000
BRACKET_ACCURACY = 100_000


def q_approx(c: ColumnOrName, qs: float | Sequence[float], accuracy: int = SKETCH_ACCURACY) -> Column:
    """Aggregate: value(s) at the given probabilities, rank error n/accuracy."""
    probs = qs if isinstance(qs, (int, float)) else [float(q) for q in qs]
    return F.percentile_approx(as_col(c), probs, accuracy)


def q_exact(c: str, q: float = 0.5, kind: str = "cont") -> Column:
    """Aggregate: exact quantile of a column, interpolated (``cont``) or an
    actual value (``disc``). Its buffer holds the distinct values of a group,
    so use it where groups are small; ``exact_quantiles`` has no such limit."""
    if kind not in ("disc", "cont"):
        raise ValueError(f"unknown kind: {kind}")
    return F.expr(f"percentile_{kind}({float(q)}) WITHIN GROUP (ORDER BY `{c}`)")


def to_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys, variable, value) of numeric columns without nulls."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keys), list(cols), "variable", "value").filter(F.col("value").isNotNull())


#: Rows that the last interval of a quantile may hold; more are narrowed first.
LAST_INTERVAL = 1_000_000
#: Steps into which a pass cuts an interval.
STEPS = 512


def _brackets(values: DataFrame, group: Sequence[str], qs: Sequence[float], kind: str, accuracy: int) -> DataFrame:
    """``group, q, lo, hi, r1, r2, share, inside``: an interval around each
    wanted rank from one sketch, and about how many rows it holds."""
    margin = 5.0 / accuracy
    probs = [float(p) for q in qs for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    sketch = values.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("value", probs, accuracy).alias("sketch")
    )
    targets = F.array(
        *[
            F.struct(
                F.lit(float(q)).alias("q"),
                F.get("sketch", F.lit(2 * i)).alias("lo"),
                F.get("sketch", F.lit(2 * i + 1)).alias("hi"),
            )
            for i, q in enumerate(qs)
        ]
    )
    n, q = F.col("n"), F.col("q")
    if kind == "disc":
        first = last = F.greatest(F.ceil(F.round(q * n, 6)), F.lit(1))
        share = F.lit(0.0)
    else:
        position = F.round(q * (n - 1), 6)
        first, last, share = F.floor(position) + 1, F.ceil(position) + 1, position - F.floor(position)
    return sketch.select(*group, "n", F.inline(targets)).select(
        *group, "q", "lo", "hi", first.alias("r1"), last.alias("r2"), share.alias("share"),
        F.ceil(n * (2 * margin + 2.0 / accuracy)).alias("inside"),
    )


def _against(values: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every value with the intervals of its group and column. They are joined
    back; whether they are broadcast is left to the size Spark measures, but for
    those without keys: a row per column and probability."""
    group = [*keys, "variable"]
    renamed = brackets.select(*[F.col(k).alias(f"_b_{k}") for k in group], "q", "lo", "hi", "r1", "r2", "share")
    if not keys:
        renamed = F.broadcast(renamed)
    match = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys] + [F.col("variable") == F.col("_b_variable")]
    return values.join(renamed, match)


def _narrowed(values: DataFrame, brackets: DataFrame, keys: Sequence[str], accuracy: int) -> DataFrame:
    """One more pass: each interval is cut into equal steps by a sketch of what
    lies inside, and the steps around the wanted ranks are the new interval."""
    v, held = F.col("value"), ["lo", "hi", "r1", "r2", "share"]
    within = v.between(F.col("lo"), F.col("hi"))
    grid = [i / STEPS for i in range(STEPS + 1)]
    cut = _against(values, brackets, keys).groupBy(*keys, "variable", "q", *held).agg(
        F.count_if(v < F.col("lo")).alias("_below"),
        F.count_if(within).alias("_inside"),
        F.percentile_approx(F.when(within, v), grid, accuracy).alias("_grid"),
    )

    def step(rank: str, aside: int) -> Column:
        place = (F.col(rank) - F.col("_below")) / F.greatest(F.col("_inside"), F.lit(1)) * STEPS
        return F.greatest(F.least(F.floor(place) + aside, F.lit(STEPS)), F.lit(0)).cast("int")

    aside = 2 + -(-2 * STEPS // accuracy)  # twice the error of the sketch
    low, high = step("r1", -aside), step("r2", aside + 1)
    rows = F.when(F.get("_grid", low) == F.get("_grid", high), 1).otherwise(F.ceil(F.col("_inside") * (high - low + 1) / STEPS))
    return cut.select(
        *keys, "variable", "q", F.get("_grid", low).alias("lo"), F.get("_grid", high).alias("hi"), "r1", "r2", "share", rows.alias("inside")
    )


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    keys: Sequence[str] = (),
    kind: str = "disc",
    accuracy: int = BRACKET_ACCURACY,
    last: int | None = LAST_INTERVAL,
) -> DataFrame:
    """Exact quantiles per group and column: ``keys, variable, q, value``.

    The intervals come from one aggregate, which runs when this is called and is
    kept in the shared folder. While an interval may hold more than ``last``
    rows it is narrowed by another pass, some hundred times each, so the rows
    that are finally sorted together are bounded however many there are. With
    ``last=None`` nothing runs before the result is asked for and the first
    intervals, about 1 in 8,000 rows, are the last.
    """
    if kind not in ("disc", "cont"):
        raise ValueError(f"unknown kind: {kind}")
    group = [*keys, "variable"]
    values = to_values(df, cols, keys)
    brackets = _brackets(values, group, qs, kind, accuracy)
    if last is not None:
        brackets = materialize(brackets)
        most = brackets.agg(F.max("inside")).first()[0] or 0
        while most > last:
            brackets = materialize(_narrowed(values, brackets, keys, accuracy))
            most, was = brackets.agg(F.max("inside")).first()[0] or 0, most
            if most >= was:
                break
    fields = ["q", "r1", "r2", "share"]
    # Rows outside an interval collapse into one entry below it and one above.
    # Only their values next to the interval can matter (to interpolate).
    v = F.col("value")
    zone = F.when(v < F.col("lo"), F.lit(0)).when(v <= F.col("hi"), F.lit(1)).otherwise(F.lit(2)).alias("zone")
    counted = (
        _against(values, brackets, keys)
        .groupBy(*group, *fields, zone, F.when(v.between(F.col("lo"), F.col("hi")), v).alias("inside"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("least"), F.max("value").alias("most"))
    )
    upto = Window.partitionBy(*group, "q").orderBy("zone", "inside").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumn("seen", F.sum("cnt").over(upto))

    def at_rank(rank: str) -> Column:
        inside = (F.col("zone") == 1) & (F.col("seen") >= F.col(rank))
        last_below = (F.col("zone") == 0) & (F.col("cnt") == F.col(rank))
        first_above = (F.col("zone") == 2) & (F.col("seen") - F.col("cnt") + 1 == F.col(rank))
        return F.min(F.when(last_below, F.col("most")).when(inside | first_above, F.col("least")))

    found = running.groupBy(*group, *fields).agg(
        at_rank("r1").alias("low"),
        at_rank("r2").alias("high"),
        F.max(F.when(F.col("zone") == 0, F.col("cnt")).otherwise(F.lit(0))).alias("below"),
    )
    missed = (F.col("below") > F.col("r1")) | F.col("low").isNull() | F.col("high").isNull()
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("share")
    checked = F.when(missed, F.raise_error(F.lit("quantile outside its sketch interval")).cast("double"))
    return found.select(*group, "q", checked.otherwise(value).alias("value"))


HOT_ROWS = 1_000_000


def entity_quantiles(
    df: DataFrame, key: str, cols: Mapping[str, str], q: float = 0.5, kind: str = "cont", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Exact quantile of several columns per entity, ``{output: column}``.

    Every entity has a row, null keys are one entity, and a column without
    values gives null, whichever way an entity goes: up to ``hot_rows`` rows
    through the built-in aggregate, whose buffer that bounds, beyond through
    ``exact_quantiles``, so no buffer ever holds a hot entity.
    """
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(F.col(key).alias("_hot"))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    exact = [q_exact(c, q, kind).cast("double").alias(name) for name, c in cols.items()]
    cold = df.join(hot, is_hot, "left_anti").groupBy(key).agg(*exact)
    columns = sorted(set(cols.values()))
    long = exact_quantiles(df.join(hot, is_hot, "left_semi"), columns, [q], [key], kind, last=None)
    wide = long.groupBy(key).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("value"))).alias(name) for name, c in cols.items()]
    )
    found = hot.join(wide, is_hot, "left").select(F.col("_hot").alias(key), *cols)
    return cold.unionByName(found)


def distinct_estimate(c: ColumnOrName) -> Column:
    """Aggregate: estimated number of distinct values (about 1.6 % error). One
    binary sketch per column keeps wide profiles plannable."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(as_col(c).cast("string"), 12))


def quantile_columns(quantiles: DataFrame, names: dict[float, str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, variable) with a column for each probability."""
    return quantiles.groupBy(*keys, "variable").agg(
        *[F.max(F.when(F.col("q") == F.lit(float(q)), F.col("value"))).alias(name) for q, name in names.items()]
    )
