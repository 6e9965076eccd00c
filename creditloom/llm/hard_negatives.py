"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. The negatives of a positive lie in a window of scores that
hangs on the positive's score. The upper limits of an anchor's windows, in falling order, cut the scores into disjoint
slots; slot ``j`` begins at the upper limit of window ``j``, so that window is slot ``j`` and some of those after it.
Each task keeps the best rows of every slot, these are combined over the tasks, and a window's answer is the head of the
slots from its own on, down to its lower limit: the windows overlap, but each row is held in one slot only.

Scores are inner products of integers, so they don't depend on the order of summing. Anchors meet rows in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.blocks import block_pairs, pieces_of
from creditloom.llm.common import stored

#: Anchors of a block and rows of a piece.
BLOCK, PIECE = 8192, 131072
#: Anchors and rows whose scores are in memory at a time.
ANCHORS, ROWS = 256, 8192
#: Scores stay below this, so that they fit into 64 bits.
LARGEST = 1 << 61


def quantised(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` of each component, held where a score could leave 64 bits (for 64 components at 2^27)."""
    most = F.floor(F.sqrt(F.lit(float(LARGEST)) / F.greatest(F.size(vector), F.lit(4))))
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(F.lit(scale) * x.cast("double")), most), -most).cast("int"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows of ``width`` columns, shorter ones filled with zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def longest(*columns: pa.ChunkedArray) -> int:
    return max((int(n) for c in columns for n in [pc.max(pc.list_value_length(c)).as_py()] if n), default=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, in doubles where these are exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if most < 1 << 53 else a @ b.T


def first(group: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` entries of each group with the highest score, the least place among equals."""
    order = np.lexsort((place, -score, group))
    ordered = group[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else np.empty(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


def candidates(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of entries among which are the ``k`` best allowed ones of each line, with all that tie."""
    if scores.shape[1] > k:
        masked = np.where(allowed, scores, np.iinfo(np.int64).min)
        least = np.partition(masked, -k, axis=1)[:, -k]
        allowed = allowed & (masked >= least[:, None])
    return np.nonzero(allowed)


def sorted_by_id(rows: pa.Table) -> pa.Table:
    """Rows by id, null last: a row's place then breaks ties."""
    return rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending")], null_placement="at_end"))


def search(anchors: pa.Table, rows: pa.Table, k: int, slotted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, slot, score, row) of the ``k`` best rows of every anchor and slot; without slots, of its own label."""
    width = longest(anchors["vector"], rows["vector"])
    right = matrix(rows["vector"], width)
    row_numbers, anchor_numbers = rows["row"].to_numpy(), anchors["row"].to_numpy()
    labels = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks], pa.string()).combine_chunks().dictionary_encode().indices.to_numpy()
    anchor_labels, row_labels = labels[: len(anchors)], labels[len(anchors) :]
    left = matrix(anchors["vector"], width)
    kept = []
    for a in range(0, len(anchors), ANCHORS):
        part = slice(a, a + ANCHORS)
        limits = [(None, None, None)]
        if slotted:
            n = longest(anchors["upper"])
            lowest = np.iinfo(np.int64).min
            upper, lower = (padded(anchors[c].slice(a, ANCHORS), n, lowest) for c in ("upper", "lower"))
            limits = [(upper[:, j], upper[:, j + 1] if j + 1 < n else np.full(len(upper), lowest), lower[:, j]) for j in range(n)]
        best = [np.empty(0, np.int64)] * 4
        for r in range(0, len(rows), ROWS):
            scores = products(left[part], right[r : r + ROWS])
            same = anchor_labels[part, None] == row_labels[None, r : r + ROWS]
            for slot, (high, low, least) in enumerate(limits):
                if high is None:
                    allowed = same & (anchor_numbers[part, None] != row_numbers[None, r : r + ROWS])
                else:
                    allowed = ~same & (scores <= high[:, None]) & (scores > low[:, None]) & (scores >= least[:, None])
                line, column = candidates(scores, allowed, k)
                new = (line + a, np.full(len(line), slot), scores[line, column], column + r)
                best = [np.concatenate(x) for x in zip(best, new, strict=True)]
            chosen = first(best[0] * len(limits) + best[1], best[2], best[3], k)
            best = [x[chosen] for x in best]
        kept.append(best)
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.empty(0, np.int64),) * 4


def padded(column: pa.ChunkedArray, width: int, fill: int) -> np.ndarray:
    return np.array([x + [fill] * (width - len(x)) for x in column.to_pylist()], np.int64).reshape(-1, width)


def best_rows(anchors: DataFrame, rows: DataFrame, k: int, blocks: int, pieces: int, slotted: bool) -> DataFrame:
    """``(row, slot, score, id)``: the ``k`` best of each anchor and slot over all rows."""

    def combine(left: pa.Table, right: pa.Table) -> pa.Table:
        right = sorted_by_id(right)
        a, slot, score, r = search(left, right, k, slotted)
        return pa.table({"row": left["row"].take(pa.array(a)), "slot": pa.array(slot, pa.int32()), "score": pa.array(score), "id": right["id"].take(pa.array(r))})

    found = block_pairs(anchors, rows, blocks, pieces, combine, "row long, slot int, score long, id long")
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def percent(share: int, up: bool) -> Column:
    """``share`` percent of a score of 0 or more, rounded up or down, without leaving 64 bits."""
    rest = F.col("score") % 100 * share / 100
    return F.expr("score div 100") * share + (F.ceil(rest) if up else F.floor(rest))


def mine(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of every anchor and positive.

    A score is the inner product of the components' ``floor(scale * x)``. An anchor's positives are the ``positives``
    best other rows of its label; the negatives of one are the ``negatives`` best rows of other labels whose scores are
    from ``low`` to ``high`` percent of the positive's. Higher scores come first, then smaller ids, null last. A
    positive of negative score has no negatives, nor has one whose window is empty; it then has no rows.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Rows that repeat an id or all
    of a row are rows of their own, also as partners of one another; a null id is an id like others. A shorter vector
    counts as filled with zeros, an empty one scores 0. Components that could take a score out of 64 bits are held at the
    largest that can't. An empty table gives an empty result. Other columns are not read.
    """
    vector = F.col(vector_col)
    taken = vectors.where(F.col(label_col).isNotNull() & usable(vector))
    rows = stored(
        taken.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
            quantised(vector, scale).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
    )
    count, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = max(1, -(-n_anchors // BLOCK))
    pieces = pieces_of(count, PIECE, blocks, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    others = rows.select("row", "id", "label", "vector")
    anchors = rows.where("anchor").drop("anchor")

    near = best_rows(anchors.drop("id"), others, positives, blocks, pieces, slotted=False)
    limits = F.struct((-F.col("score")).alias("falling"), F.col("id").isNull().alias("no_id"), "id", "score", percent(high, up=False).alias("upper"), percent(low, up=True).alias("lower"))
    of_anchor = near.where("score >= 0").groupBy("row").agg(F.sort_array(F.collect_list(limits)).alias("positives"))
    targets = stored(anchors.join(of_anchor, "row"))

    asked = targets.select("row", "label", "vector", F.transform("positives", lambda p: p["upper"]).alias("upper"), F.transform("positives", lambda p: p["lower"]).alias("lower"))
    slots = best_rows(asked, others, negatives, blocks, pieces, slotted=True)
    entry = F.struct("slot", (-F.col("score")).alias("falling"), F.col("id").isNull().alias("no_id"), "id", "score")
    held = slots.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("held"))

    def window(positive: Column, place: Column) -> Column:
        onward = F.slice(F.filter("held", lambda e: e["slot"] >= place), 1, negatives)
        inside = F.filter(onward, lambda e: e["score"] >= positive["lower"])
        return F.struct(positive["id"].alias("id"), positive["score"].alias("score"), inside.alias("negatives"))

    answers = targets.join(held, "row").select(F.col("id").alias("anchor_id"), F.inline(F.transform("positives", window)))
    found = answers.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode("negatives").alias("place", "negative"))
    return found.select(
        "anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
        "positive_score", F.col("negative.score").alias("negative_score"),
    )
