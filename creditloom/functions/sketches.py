"""Quantile sketches that are kept as binary columns and merged later.

A sketch of a load is made once; sketches of many loads, days or partitions are
merged without reading the rows again. ``percentile_approx`` keeps no state that
could be merged, so a new load would mean reading everything anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import ColumnOrName, as_col

#: Size of a sketch: up to this many values it holds them all and is exact.
SKETCH_SIZE = 1024


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Stated error of a rank as a share of the rows, at 99 % confidence; it
    does not grow by merging."""
    # The published fit for KLL sketches.
    return 2.296 / size**0.9723


def value_sketch(c: ColumnOrName, size: int = SKETCH_SIZE) -> Column:
    """Aggregate: sketch of a column's values; nulls are not counted."""
    return F.kll_sketch_agg_double(as_col(c).cast("double"), size)


def merged_sketch(c: ColumnOrName, size: int = SKETCH_SIZE) -> Column:
    """Aggregate: one sketch of all values that went into the sketches."""
    return F.kll_merge_agg_double(as_col(c), size)


def sketched_count(sketch: ColumnOrName) -> Column:
    return F.coalesce(F.kll_sketch_get_n_double(as_col(sketch)), F.lit(0).cast("long"))


def sketched_quantile(sketch: ColumnOrName, q: float | Sequence[float]) -> Column:
    """Value at ``q`` (an actual value, the least whose rank reaches ``q``), or
    an array of them; null for a sketch of no values."""
    asked = F.lit(float(q)) if isinstance(q, (int, float)) else F.array(*[F.lit(float(x)) for x in q])
    return F.when(sketched_count(sketch) > 0, F.kll_sketch_get_quantile_double(as_col(sketch), asked))


def sketched_rank(sketch: ColumnOrName, value: ColumnOrName) -> Column:
    """Share of the values that are at most ``value``."""
    return F.when(sketched_count(sketch) > 0, F.kll_sketch_get_rank_double(as_col(sketch), as_col(value).cast("double")))
