"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared runs of tokens (seeds). For each pair that shares some, the longest
matches are marked as tiles again and again, none overlapping another, found by running Karp-Rabin at falling lengths.
The share of an item's tokens under tiles is its coverage, whatever the order in which its parts occur.

The benchmark goes to the tasks in blocks of bounded size, one pass over the documents for each, so its size sets the
number of passes and not the memory. A document is read whole, in the task that has it; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import map_batches, shipped

#: Tokens of the shortest tile, and of a seed.
SHORTEST = 4
#: Share of an item's tokens that marks a document as contaminated.
COVERAGE = 0.5
#: Characters of benchmark text in one block.
BLOCK_CHARS = 8_000_000

#: Scripts written without blanks, of which every character is a token: Thai to Tibetan, Burmese, Khmer, kana, Han.
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
TOKEN = re.compile(f"[{UNSPACED}]|[^\\W{UNSPACED}]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``width``, by doubling."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, block, have = np.full(1, BASE), ids.astype(np.uint64) * BASE + np.uint64(1), 1
    out, done = np.zeros(n, np.uint64), 0
    while True:
        if width & have:
            out = out * power + block[done : done + n]
            done += have
        if have * 2 > width:
            return out
        block = block[:-have] * power + block[have:]
        power, have = power * power, have * 2


@dataclass
class Block:
    """Items of one block, their tokens as numbers, one item after the other; ``seeds`` in order with the places they begin at.

    ``owner`` has the item of each token and ``lengths`` the tokens of each item. Items shorter than a seed are found by
    all their tokens: ``short`` has them by these.
    """

    items: list[tuple[object, np.ndarray]] = field(default_factory=list)
    vocabulary: dict[str, int] = field(default_factory=dict)
    seeds: np.ndarray | None = None
    places: np.ndarray | None = None
    owner: np.ndarray | None = None
    lengths: np.ndarray | None = None
    short: dict[tuple[int, ...], list[object]] = field(default_factory=dict)

    def reach(self, codes: np.ndarray) -> np.ndarray:
        """For each item how many of its tokens lie under a seed of ``codes``; no tile goes beyond them.

        All items at once, so a seed that very many of them hold costs its places and nothing more.
        """
        low, high = np.searchsorted(self.seeds, codes, "left"), np.searchsorted(self.seeds, codes, "right")
        shared = np.flatnonzero(high > low)
        under = np.zeros(len(self.owner) if len(shared) else 0, bool)
        for at in shared:
            begins = self.places[low[at] : high[at]]
            for shift in range(SHORTEST):
                under[begins + shift] = True
        return np.bincount(self.owner[np.flatnonzero(under)], minlength=len(self.items))


def block_of(rows: list[tuple[object, str | None]]) -> Block:
    block = Block()
    hashes, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    for key, text in rows:
        ids = np.array([block.vocabulary.setdefault(t, len(block.vocabulary)) for t in tokens(text)], np.int64)
        if 0 < len(ids) < SHORTEST:
            block.short.setdefault(tuple(ids.tolist()), []).append(key)
        elif len(ids):
            hashes.append(rolling(ids, SHORTEST))
            places.append(np.arange(at, at + len(hashes[-1])))
            block.items.append((key, ids))
            at += len(ids)
    seeds, place = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(seeds, kind="stable")
    block.seeds, block.places = seeds[order], place[order]
    block.lengths = np.array([len(ids) for _, ids in block.items], np.int64)
    block.owner = np.repeat(np.arange(len(block.items)), block.lengths)
    return block


def matches(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of unmarked tokens of ``width`` or more: (length, place in item, place in text)."""
    where: dict[int, list[int]] = {}
    for p, h in enumerate(rolling(item, width).tolist()):
        if free_item[p : p + width].all():
            where.setdefault(h, []).append(p)
    if not where:
        return []
    found, codes = [], rolling(text, width)
    for t in np.flatnonzero(np.isin(codes, np.fromiter(where, np.uint64, len(where)))).tolist():
        if not free_text[t : t + width].all():
            continue
        for p in where[int(codes[t])]:
            if p and t and free_item[p - 1] and free_text[t - 1] and item[p - 1] == text[t - 1]:
                continue  # part of a longer run that began before
            n = 0
            while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and free_item[p + n] and free_text[t + n]:
                n += 1
            if n >= width:
                found.append((n, p, t))
    return found


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Greedy tiling: (length, place in item, place in text), longest first, earlier places first among equals.

    What longer tiles leave of a match is a match again and takes its turn by its own length.
    """
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    marked, width = [], max(shortest, len(item) // 2)
    while True:
        queue = [(-n, p, t) for n, p, t in matches(item, text, free_item, free_text, width)]
        heapify(queue)
        while queue:
            n, p, t = heappop(queue)
            free = free_item[p : p - n] & free_text[t : t - n]
            if free.all():
                free_item[p : p - n] = free_text[t : t - n] = False
                marked.append((-n, p, t))
                continue
            borders = np.flatnonzero(np.diff(free, prepend=False, append=False)).tolist()
            for a, b in zip(borders[::2], borders[1::2], strict=True):
                if b - a >= width:
                    heappush(queue, (a - b, p + a, t + a))
        if width == shortest:
            return marked
        width = max(shortest, width // 2)


def hits(text: str | None, block: Block, coverage: float) -> list[tuple[object, int, int, int]]:
    """(item, its tokens, tiles, tokens covered) of the items that reach ``coverage`` in this text."""
    ids = np.fromiter(map(block.vocabulary.get, words := tokens(text), repeat(-1)), np.int64, len(words))
    known = ids >= 0
    out = []
    for width in sorted({len(s) for s in block.short}):
        held = set(zip(*(ids[i : len(ids) - width + 1 + i].tolist() for i in range(width)), strict=True)) if len(ids) >= width else set()
        out += [(key, width, 1, width) for s in sorted(held & block.short.keys()) for key in block.short[s]]
    if known.sum() < SHORTEST:
        return out
    reach = block.reach(np.unique(rolling(ids, SHORTEST)))
    for i in np.flatnonzero((reach > 0) & (reach >= coverage * block.lengths)).tolist():
        key, item = block.items[i]
        found = tiles(item, ids)
        covered = sum(n for n, _, _ in found)
        if covered >= coverage * len(item):
            out.append((key, len(item), len(found), covered))
    return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark in blocks of about ``BLOCK_CHARS`` characters; null texts match nothing and are left out."""
    texts = benchmark.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    count = 1 + (texts.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS
    for i in range(count):
        rows = texts.where(F.pmod(F.xxhash64("key", "text"), F.lit(count)) == i).collect()
        yield block_of([(r["key"], r["text"]) for r in rows])


def find(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(id_col, item_col, item_tokens, n_tiles, covered, coverage)`` for each document and item it contains.

    Repeated documents or items give repeated rows; null ids are kept; null or empty texts contain nothing and are
    contained nowhere. An item of fewer than four tokens is contained where all of them follow one another, whatever
    ``coverage``. Other columns are not read.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, item_tokens long, n_tiles long, covered long"

    def search(shared) -> Callable[[pa.RecordBatch], dict[str, list]]:
        def rows(batch: pa.RecordBatch) -> dict[str, list]:
            block = shared()
            out: dict[str, list] = {id_col: [], item_col: [], "item_tokens": [], "n_tiles": [], "covered": []}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for item, n, count, covered in hits(text, block, coverage):
                    for column, value in zip(out.values(), (key, item, n, count, covered), strict=True):
                        column.append(value)
            return out

        return rows

    found = None
    for block in blocks(benchmark, item_col, item_text_col):
        part = map_batches(source, search(shipped(docs.sparkSession, block)), schema)
        found = part if found is None else found.union(part)
    return found.withColumn("coverage", F.col("covered") / F.col("item_tokens"))


def clean(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Rows of ``docs`` that contain no item, all columns as they are; cases as in ``find``."""

    def search(shared, place: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared()
            for batch in batches:
                yield batch.filter(pa.array([not hits(t, block, coverage) for t in batch.column(place).to_pylist()], pa.bool_()))

        return run

    for block in blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(search(shipped(docs.sparkSession, block), docs.columns.index(text_col)), docs.schema)
    return docs
