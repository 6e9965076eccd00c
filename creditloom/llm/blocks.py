"""A query set against all rows, in blocks of both, dealt out by Spark."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pieces_of(rows: int, most: int, blocks: int, parts: int, least: int = 1024) -> int:
    """Pieces of at most about ``most`` rows, and enough of at least ``least`` rows to give every task some."""
    return max(1, -(-rows // most), min(-(-parts // blocks), rows // least))


def block_pairs(
    queries: DataFrame, rows: DataFrame, blocks: int, pieces: int, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``search(block of queries, piece of rows)`` for each of the ``blocks * pieces`` combinations, one after another in a task.

    Both sides need a column ``row`` with a number of its own for each row, by whose hash they are dealt; so blocks and
    pieces are even whatever the values. Rows move once for each block and queries once for each piece; nothing is
    broadcast or collected. A combination may lack one side.
    """
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("_block", part(blocks)).withColumn("_piece", every(pieces))
    right = rows.withColumn("_piece", part(pieces)).withColumn("_block", every(blocks))
    return left.groupBy("_block", "_piece").cogroup(right.groupBy("_block", "_piece")).applyInArrow(search, schema)
