"""Ranked lexical search: exact maximum inner product search in sparse ball-trees.

A document is the vector of its terms' integer impacts, times the terms' weights; an item is the set of its terms, and
its score of a document the sum of the vector over this set. Documents are dealt into cells; in each, a ball-tree halves
them again and again along the line between two far documents, and every node has the centroid and the radius of its
documents, and their radius along each term's axis. No document of a node scores more than the centroid's sum over the
item's terms plus the radius times the root of their number, nor more than the centroid's sum plus that of the radii
along these terms; the lesser is the node's bound. For each item the tree is searched best bound first, until no bound reaches the item's k-th best score so far. Leaves are
scored in integers, so ranks are exact; bounds are in doubles and rounded up by more than their error.

Only terms of the items matter: their documents' other terms are left out by a set of hashed terms of fixed size, which
may let some through. Items meet cells in blocks.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.blocks import block_pairs, pieces_of
from creditloom.llm.common import shipped, stored
from creditloom.llm.hard_negatives import sorted_by_id
from creditloom.llm.terms import terms

#: Slots of the set of hashed terms, and those of one bitmap.
SLOTS, BITMAP = 1 << 22, 1 << 15
#: Documents and terms of a cell, items and terms of a block.
CELL, CELL_TERMS = 16384, 4_000_000
BLOCK, BLOCK_TERMS = 1024, 1_000_000
#: Documents of a leaf.
LEAF = 32
#: Texts whose terms are in memory at a time.
SLICE = 1024
#: What is added to bounds and squared radii, as a share of the numbers that went into them: some 10,000 times their error.
SLACK = 1e-9


def postings(rows: DataFrame, id_col: str, text_col: str, keep: DataFrame | None = None) -> DataFrame:
    """``(id, n, terms, counts)`` of each text: all its terms counted, and the distinct ones in the slots of ``keep``."""
    kept = None if keep is None else shipped(rows.sparkSession, {r["bucket"]: bytes(r["bits"]) for r in keep.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        if kept is not None:
            held = np.zeros(SLOTS, bool)
            for bucket, bits in kept().items():
                held[(bucket - 1) * BITMAP : bucket * BITMAP] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
            held = held.tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                total, ends, words, counts = [], [0], [], []
                for text in pc.cast(part.column(1), pa.binary()).to_pylist():
                    found = terms(text)
                    total.append(len(found))
                    for word, n in Counter(found).items():
                        if held is None or held[zlib.crc32(word) & SLOTS - 1]:
                            words.append(word)
                            counts.append(n)
                    ends.append(len(words))
                offsets = pa.array(ends, pa.int32())
                columns = [part.column(0), pa.array(total, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(words, pa.string())), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "counts"])

    kind = rows.schema[id_col].dataType.simpleString()
    source = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {kind}, n long, terms array<string>, counts array<long>")


def slots_of(items: DataFrame) -> DataFrame:
    """The slots of all terms of the items, as bitmaps: ``SLOTS / BITMAP`` rows of 4 KB at most."""
    slot = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(SLOTS - 1)) + 1
    return items.select(F.explode("terms").alias("term")).groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


@dataclass
class Node:
    low: int
    high: int
    terms: np.ndarray
    centroid: np.ndarray
    radius: float
    axes: np.ndarray
    parts: tuple[int, int] | None = None


def chosen(starts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of the documents ``order``, and where each document's begin among them."""
    sizes = starts[order + 1] - starts[order]
    begins = np.r_[0, np.cumsum(sizes)]
    return np.repeat(starts[order] - begins[:-1], sizes) + np.arange(begins[-1]), begins


class BallTree:
    """Documents as sparse vectors of integers: ``starts`` of each one's entries in ``codes`` and ``values``, codes below ``width``."""

    def __init__(self, starts: np.ndarray, codes: np.ndarray, values: np.ndarray, width: int):
        self.width, self.nodes = width, []
        count = len(starts) - 1
        order = np.arange(count)
        todo = [(0, count, None)] if count else []
        while todo:
            low, high, parent = todo.pop()
            at, begins = chosen(starts, order[low:high])
            node, turned = self.ball(low, high, begins, codes[at], values[at].astype(float))
            if parent is not None:
                self.nodes[parent].parts = (*(self.nodes[parent].parts or ()), len(self.nodes))
            if turned is not None:
                order[low:high] = order[low:high][turned[0]]
                middle = low + turned[1]
                todo += [(low, middle, len(self.nodes)), (middle, high, len(self.nodes))]
            self.nodes.append(node)
        self.order = order
        at, begins = chosen(starts, order)
        place = np.repeat(np.arange(count), np.diff(begins))
        self.stride = max(count, 1)
        key = codes[at] * self.stride + place
        by_term = np.argsort(key, kind="stable")
        self.key, self.values = key[by_term], values[at][by_term]

    def ball(self, low: int, high: int, begins: np.ndarray, codes: np.ndarray, x: np.ndarray) -> tuple[Node, tuple[np.ndarray, int] | None]:
        """A node over these documents and, unless it is a leaf, their order along the line between two far ones and where to cut it.

        The cut is at the widest gap of the middle half, so that groups stay together and the tree's depth is bounded.
        """
        count = high - low
        owner = np.repeat(np.arange(count), np.diff(begins))
        lengths = np.bincount(owner, x * x, count)

        def distances(vector: np.ndarray, length: float) -> np.ndarray:
            return lengths - 2 * np.bincount(owner, x * vector[codes], count) + length

        centroid = np.bincount(codes, x, self.width) / count
        length = float(centroid @ centroid)
        away = distances(centroid, length)
        radius = float(np.sqrt(np.maximum(away + SLACK * (lengths + length), 0).max())) * (1 + SLACK)
        own = np.flatnonzero(centroid)
        most = np.zeros(self.width)
        np.maximum.at(most, codes, x)
        node = Node(low, high, own, centroid[own], radius, most[own] - centroid[own])
        if count <= LEAF:
            return node, None

        def dense(i: int) -> np.ndarray:
            part = slice(begins[i], begins[i + 1])
            return np.bincount(codes[part], x[part], self.width)

        first = int(away.argmax())
        to_first = distances(dense(first), lengths[first])
        second = int(to_first.argmax())
        along = to_first - distances(dense(second), lengths[second])
        order = np.argsort(along, kind="stable")
        gaps = np.diff(along[order][count // 4 : count - count // 4])
        return node, (order, count // 4 + 1 + int(gaps.argmax()) if gaps.max() > 0 else count // 2)

    def bound(self, node: Node, query: np.ndarray) -> float:
        if not len(node.terms):
            return 1.0
        at = np.searchsorted(node.terms, query)
        at[at == len(node.terms)] = 0
        at = at[node.terms[at] == query]
        beyond = min(len(query) ** 0.5 * node.radius, float(node.axes[at].sum()))
        return (float(node.centroid[at].sum()) + beyond) * (1 + SLACK) + 1

    def leaf(self, node: Node, query: np.ndarray) -> np.ndarray:
        """Scores of a leaf's documents."""
        low, high = np.searchsorted(self.key, query * self.stride + node.low), np.searchsorted(self.key, query * self.stride + node.high)
        sizes = high - low
        at = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores = np.zeros(node.high - node.low, np.int64)
        np.add.at(scores, self.key[at] % self.stride - node.low, self.values[at])
        return scores

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(scores, documents) of the ``k`` best with a score above 0, least number first among equals; leaves seen."""
        scores, docs, seen = np.empty(0, np.int64), np.empty(0, np.int64), 0
        if not len(query) or not self.nodes:
            return scores, docs, seen
        heap = [(-self.bound(self.nodes[0], query), 0)]
        while heap:
            bound, i = heapq.heappop(heap)
            if len(scores) == k and -bound < scores[-1]:
                break
            node = self.nodes[i]
            if node.parts is not None:
                for part in node.parts:
                    heapq.heappush(heap, (-self.bound(self.nodes[part], query), part))
                continue
            seen += 1
            found = self.leaf(node, query)
            good = np.flatnonzero(found >= (scores[-1] if len(scores) == k else 1))
            if len(good):
                scores, docs = np.r_[scores, found[good]], np.r_[docs, self.order[node.low + good]]
                best = np.lexsort((docs, -scores))[:k]
                scores, docs = scores[best], docs[best]
        return scores, docs, seen


def flat(table: pa.Table, column: str) -> tuple[np.ndarray, pa.Array]:
    """Where each row's list begins, and the lists one after another."""
    lists = table[column].combine_chunks()
    return np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64), lists.flatten()


def tree_of(docs: pa.Table, words: pa.Array, weights: np.ndarray) -> BallTree:
    """Tree of the documents over the ``words``, which are numbered by their place, each impact times the word's weight."""
    starts, found = flat(docs, "terms")
    codes = pc.fill_null(pc.index_in(found, value_set=words), -1).to_numpy().astype(np.int64)
    counts = flat(docs, "counts")[1].to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(docs)), np.diff(starts))
    values = (1_000_000_000 * counts) // (1000 * counts + 20 * docs["m"].to_numpy()[owner]) * np.r_[weights, 0][codes]
    real = (codes >= 0) & (values > 0)
    kept = np.bincount(owner[real], minlength=len(docs)) if len(docs) else np.empty(0, np.int64)
    return BallTree(np.r_[0, np.cumsum(kept)].astype(np.int64), codes[real], values[real], max(len(words), 1))


def search_cell(items: pa.Table, docs: pa.Table, k: int) -> pa.Table:
    """``(row, item, score, id)``: the ``k`` best documents of the cell for each item."""
    docs = sorted_by_id(docs)
    starts, found = flat(items, "terms")
    words = pc.unique(found)
    codes = pc.index_in(found, value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
    weights = np.zeros(len(words), np.int64)
    weights[codes] = flat(items, "weights")[1].to_numpy()
    tree = tree_of(docs, words, weights)
    which, scores, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(len(items)):
        best, at, _ = tree.search(np.sort(codes[starts[i] : starts[i + 1]]), k)
        which.append(np.full(len(best), i))
        scores.append(best)
        places.append(at)
    rows = pa.array(np.concatenate(which))
    return pa.table({"row": items["row"].take(rows), "item": items["item"].take(rows), "score": pa.array(np.concatenate(scores)), "id": docs["id"].take(pa.array(np.concatenate(places)))})


def rank(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(item_col, rank, id_col, score)``: the ``k`` documents of highest score above 0 for each item, least ids first among equals.

    With N documents that have a term, L terms in them, n in one and df documents that hold a term, a term weighs
    ``floor(1000 * ln((2 N + 2) / (2 df + 1)))``, a document's length is ``m = 50 + (50 n N) div L``, and it scores the sum
    of ``weight * (1e9 tf div (1000 tf + 20 m))`` over the item's terms, each once.

    Null and empty texts have no terms and are no result. Rows that repeat an id or all of a row are documents, or items,
    of their own; null ids come last among equal scores. Without documents or items the result is empty. Other columns
    are not read.
    """
    asked = stored(postings(items, item_col, item_text_col).withColumn("row", F.monotonically_increasing_id()))
    held = stored(postings(docs, id_col, text_col, slots_of(asked)).withColumn("row", F.monotonically_increasing_id()))
    total, length, found, count = held.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.sum(F.size("terms")), F.count_if(F.size("terms") > 0)).first()

    frequency = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.ln((2.0 * F.lit(total) + 2) / (2 * F.col("df") + 1)))
    weighed = asked.select("row", F.col("id").alias("item"), F.explode("terms").alias("term")).join(frequency, "term").withColumn("weight", weight)
    of_item = weighed.where("weight > 0").groupBy("row", "item").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("t"))
    queries = stored(of_item.select("row", "item", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")))
    n_items, n_terms = queries.agg(F.count("*"), F.sum(F.size("terms"))).first()

    m = F.expr(f"CAST(50 + (CAST(n AS DECIMAL(20)) * 50 * {total}BD) DIV {max(length or 0, 1)}BD AS BIGINT)")
    vectors = held.where(F.size("terms") > 0).select("row", "id", m.alias("m"), "terms", "counts")
    blocks = max(1, -(-n_items // BLOCK), -(-(n_terms or 0) // BLOCK_TERMS))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(pieces_of(count, CELL, blocks, parts, 4096), -(-(found or 0) // CELL_TERMS))

    kinds = [x.schema["id"].dataType.simpleString() for x in (asked, held)]
    best = block_pairs(queries, vectors, blocks, pieces, lambda a, b: search_cell(a, b, k), f"row long, item {kinds[0]}, score long, id {kinds[1]}")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
