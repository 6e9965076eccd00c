"""Removal of repeated byte strings by prefix-free parsing: suffixes in the order of dictionary and parse.

A rolling hash over windows of 32 bytes sets triggers: the places of its minima, which depend on nothing but the bytes
around them and of which every 100-byte string holds one. Triggers cut a text into phrases. A phrase is kept with the
bytes that 100-byte strings beginning in it reach into the phrases that follow, so the dictionary of distinct phrases
holds every such string and the parse (which phrase stands where) says where it occurs. The suffix array of the
dictionary is cut at 100 bytes, as longer matches are not asked for: suffixes are sorted by their bytes by prefix
doubling, and those that agree in all 100 come in the order of the parse, so the first of them is the first of the corpus.
Equal strings have equal triggers. So each trigger's part of the dictionary is sorted by itself, and parts in parallel.

1. The parse is dealt by trigger and sorted. Where a phrase occurs again, all its strings repeat, and all but the first
   occurrence are removed whole. This is where repetitive text shrinks to its dictionary. A batch of texts hands on one
   row for a phrase with its places, so a phrase that a third of all texts hold makes a row per batch.
2. A trigger with one phrase is done: its strings are unique. Distinct phrases with one trigger may share some strings,
   and only their suffixes are sorted, all phrases of a trigger together. A trigger with very many phrases has its
   suffixes written out and dealt by two hashes of their 100 bytes instead, the least place of each found by an
   aggregate, so that no task sorts them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import occupied, slot, stored

#: Bytes of the strings that are compared.
WIDTH = 100
#: Bytes under the rolling hash.
GRAM = 32
#: Windows of which the least hash is a trigger; a string of WIDTH bytes has exactly so many.
SPAN = WIDTH - GRAM + 1

#: Bytes that are hashed at a time.
PIECE = 1 << 20
#: Distinct phrases of one trigger up to which their suffixes are sorted in one place; ``PIECE`` bytes hold them all.
GROUP = 4096
#: Bytes of a text that are parsed at a time. A phrase across the border is two; its strings meet in step 2.
BLOCK = PIECE
#: Low bits of a mixed hash that give way to the place, so that the leftmost of equal minima is taken.
PLACE_BITS = np.uint64(21)

#: Odd bases of the two rolling hashes, modulo 2 ** 64.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
Tables = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def hash_tables() -> Tables:
    """For each hash a number for every byte, and the powers and inverse powers of its base; made anew in each task."""
    random = np.random.default_rng(7)
    tables = []
    for base in BASES:
        numbers = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        powers = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(PIECE + WIDTH, b, np.uint64)])) for b in (base, pow(base, -1, 1 << 64))]
        tables.append((numbers, *powers))
    return tables


def encoded(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sums(raw: np.ndarray, table: tuple) -> np.ndarray:
    values, powers, _ = table
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[raw] * powers[: len(raw)])])


def rolling(total: np.ndarray, width: int, table: tuple) -> np.ndarray:
    """Hashes of all windows of ``width`` bytes from the running sums of a block."""
    return mixed((total[width:] - total[:-width]) * table[2][: len(total) - width])


def identity(total: np.ndarray, first: np.ndarray, last: np.ndarray, table: tuple) -> np.ndarray:
    """One of the two 64-bit hashes of phrases from the strings at ``first`` and ``last``."""
    a, b = (mixed((total[at + WIDTH] - total[at]) * table[2][at]) for at in (first, last))
    return mixed(a * np.uint64(3) + b).view(np.int64)


def phrases(raw: np.ndarray, tables: Tables) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash at the trigger, two hashes of the phrase, first string start, number of string starts) of the phrases of a text, by block.

    The strings that begin in one phrase are those with the same trigger. Their first and last cover all bytes that any
    of them reaches, so their hashes are the phrase's. What is removed as a repeat has 128 bits in common.
    """
    table = tables[0]
    for at in range(0, len(raw) - WIDTH + 1, BLOCK):
        total = sums(raw[at : at + BLOCK + WIDTH - 1], table)
        n = len(total) - WIDTH
        grams = rolling(total, GRAM, table)
        least = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
        have = 1
        while have * 2 <= SPAN:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[:n], least[SPAN - have : SPAN - have + n])
        trigger = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
        starts = np.flatnonzero(np.diff(trigger, prepend=-1))
        counts = np.diff(starts, append=n)
        totals = (total, sums(raw[at : at + BLOCK + WIDTH - 1], tables[1]))
        phrase, other = (identity(t, starts, starts + counts - 1, tables[i]) for i, t in enumerate(totals))
        yield (grams[trigger[starts]] >> np.uint64(16)).view(np.int64), phrase, other, (starts + at).astype(np.int32), counts.astype(np.int16)


PLACE = pa.struct([("id", pa.int64()), ("start", pa.int32())])
PARSE = "trigger long, phrase long, other long, n short, id long, start int, more array<struct<id:long,start:int>>"


def parse(texts: DataFrame) -> DataFrame:
    """The parse by phrase: in each batch of texts a phrase's first place ``(id, start)`` and its others in ``more``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = hash_tables()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            found = [(i, block) for i, text in enumerate(batch.column(1).to_pylist()) for block in phrases(encoded(text), tables)]
            if not found:
                continue
            owner = ids[np.repeat([i for i, _ in found], [len(block[0]) for _, block in found])]
            trigger, phrase, other, start, n = (np.concatenate([block[j] for _, block in found]) for j in range(5))
            order = np.lexsort((start, owner, n, other, phrase, trigger))
            trigger, phrase, other, start, n, owner = (x[order] for x in (trigger, phrase, other, start, n, owner))
            head = np.ones(len(order), bool)
            head[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in (trigger, phrase, other, n)])
            rest = np.flatnonzero(~head)
            offsets = np.concatenate([[0], np.cumsum(np.diff(np.flatnonzero(head), append=len(head)) - 1)]).astype(np.int32)
            places = pa.StructArray.from_arrays([pa.array(owner[rest]), pa.array(start[rest])], fields=list(PLACE))
            columns = [pa.array(x[head]) for x in (trigger, phrase, other, n, owner, start)]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), places)], ["trigger", "phrase", "other", "n", "id", "start", "more"])

    return texts.select("id", "text").mapInArrow(run, PARSE)


def judged(parsed: DataFrame) -> DataFrame:
    """``(again, trigger, id, start, n)`` of a parse: places of phrases that occur earlier, and with ``again`` false the
    first places of phrases whose trigger has others.

    Rows come sorted by trigger, phrase and place; the last row is all that is carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # trigger, phrase, other, n, and its first place while no other phrase of the trigger came
        for batch in batches:
            trigger, phrase, other, n, owner, start = (batch.column(i).to_numpy() for i in range(6))
            if not len(trigger):
                continue
            before = [np.concatenate([[x], column[:-1]]) for x, column in zip(last or (trigger[0] ^ 1, 0, 0, 0), (trigger, phrase, other, n), strict=False)]
            same_trigger = trigger == before[0]
            again = same_trigger & (phrase == before[1]) & (other == before[2]) & (n == before[3])
            more = batch.column(6)
            lengths = np.diff(more.offsets.to_numpy())
            others = more.flatten()
            out = [(np.ones(len(others), bool), np.repeat(trigger, lengths), others.field("id").to_numpy(), others.field("start").to_numpy(), np.repeat(n, lengths)),
                   (np.ones(again.sum(), bool), trigger[again], owner[again], start[again], n[again])]
            new = np.flatnonzero(~again)
            held = last[4] if last else None
            if len(new):
                follows = same_trigger[new]
                shown = follows.copy()
                shown[:-1] |= follows[1:]  # a phrase that another of its trigger follows
                if held is not None and follows[0]:
                    out.append(tuple(np.array([x]) for x in (False, last[0], *held, last[3])))
                final = new[-1]
                pending = not shown[-1]
                place = new[shown]
                out.append((np.zeros(len(place), bool), trigger[place], owner[place], start[place], n[place]))
                held = (owner[final], start[final]) if pending else None
                last = (trigger[final], phrase[final], other[final], n[final], held)
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int16())
            columns = [pa.array(np.concatenate([part[i] for part in out]), kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["again", "trigger", "id", "start", "n"])

    rows = parsed.repartition("trigger").sortWithinPartitions("trigger", "phrase", "other", "n", "id", "start")
    return rows.mapInArrow(run, "again boolean, trigger long, id long, start int, n short")


def phrase_bytes(spans: DataFrame) -> DataFrame:
    """``(trigger, id, start, data)``: the phrases of ``(id, text, spans)`` with all bytes their strings reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                rows += [(s["trigger"], key, s["start"], raw[s["start"] : s["start"] + s["n"] + WIDTH - 1]) for s in found]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["trigger", "id", "start", "data"])

    return spans.select("id", "text", "spans").mapInArrow(run, "trigger long, id long, start int, data binary")


def ranks(raw: np.ndarray) -> np.ndarray:
    """Rank by bytes of the string of ``WIDTH`` bytes at each place where one begins; equal strings have one rank.

    Prefix doubling: ranks of eight bytes from big-endian words, then of two shorter strings side by side.
    """
    count = len(raw) - WIDTH + 1
    words = np.zeros(len(raw) - 7, np.uint64)
    for i in range(8):
        words = words << np.uint64(8) | raw[i : len(raw) - 7 + i]
    rank, have = np.unique(words, return_inverse=True)[1], 8
    while have < WIDTH and rank.max() + 1 < len(rank):  # all different: longer strings keep this order
        step = min(have, WIDTH - have)
        rank = np.unique(rank[:-step] * len(rank) + rank[step:], return_inverse=True)[1]
        have += step
    return rank[:count]


def ordered_suffixes(rows: DataFrame) -> DataFrame:
    """``(id, start, n)``: strings of the phrases of a trigger that begin earlier in another of them.

    Rows come sorted by trigger and place, all phrases of a trigger together, at most ``GROUP``. Their suffixes are
    sorted by the first ``WIDTH`` bytes, then by place in the parse.
    """

    def repeats(owner: np.ndarray, start: np.ndarray, data: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(d) for d in data])
        raw = np.frombuffer(b"".join(data), np.uint8)
        counts = sizes - WIDTH + 1
        which = np.repeat(np.arange(len(data)), counts)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(np.cumsum(sizes) - sizes, counts) + inner
        rank = ranks(raw)[at]
        array = np.argsort(rank, kind="stable")
        again = np.sort(array[1:][rank[array[1:]] == rank[array[:-1]]])
        begins = np.ones(len(again), bool)
        begins[1:] = (again[1:] != again[:-1] + 1) | (which[again[1:]] != which[again[:-1]])
        first = again[begins]
        length = np.diff(np.flatnonzero(begins), append=len(again))
        return [owner[which[first]], (start[which[first]] + inner[first]).astype(np.int32), length.astype(np.int16)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole triggers, as many at a time as ``PIECE`` bytes hold."""
            trigger, owner, start = (table.column(i).to_numpy() for i in range(3))
            data = table.column(3).to_pylist()
            ends = [*(np.flatnonzero(trigger[1:] != trigger[:-1]) + 1), len(trigger)]
            total = np.concatenate([[0], np.cumsum([len(d) for d in data])])
            first = 0
            for i, end in enumerate(ends):
                if end == len(trigger) or total[ends[i + 1]] - total[first] > PIECE:
                    found = repeats(owner[first:end], start[first:end], data[first:end])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["id", "start", "n"])
                    first = end

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            trigger = table.column(0).to_numpy()
            cut = int(np.searchsorted(trigger, trigger[-1], "left")) if len(trigger) else 0
            if cut:
                yield from done(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from done(rest)

    dealt = rows.repartition("trigger").sortWithinPartitions("trigger", "id", "start")
    return dealt.mapInArrow(run, "id long, start int, n short")


def suffixes(spans: DataFrame) -> DataFrame:
    """``(key, key2, id, at)``: every string that begins in the spans of ``(id, text, spans)``, by two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = hash_tables()
        for batch in batches:
            keys, others, owners, places = [], [], [], []
            for i, (text, found) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                raw = encoded(text)
                for first, last in merged(found):
                    for at in range(first, last, PIECE):
                        piece = raw[at : min(last, at + PIECE) + WIDTH - 1]
                        key, other = (rolling(sums(piece, table), WIDTH, table) for table in tables)
                        keys.append(key.view(np.int64))
                        others.append((other >> np.uint64(32)).astype(np.uint32).view(np.int32))
                        owners.append(np.full(len(key), i))
                        places.append(np.arange(at, at + len(key), dtype=np.int32))
            if keys:
                key, other, owner, place = (pa.array(np.concatenate(x)) for x in (keys, others, owners, places))
                yield pa.RecordBatch.from_arrays([key, other, batch.column(0).take(owner), place], ["key", "key2", "id", "at"])

    return spans.select("id", "text", "spans").mapInArrow(run, "key long, key2 int, id long, at int")


def merged(spans: list[dict], reach: int = 0) -> list[tuple[int, int]]:
    """Joined ranges of the string starts in the spans, each made longer by ``reach``."""
    runs: list[list[int]] = []
    for first, last in sorted((s["start"], s["start"] + s["n"] + reach) for s in spans):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    return [(a, b) for a, b in runs]


def cut(texts: DataFrame) -> DataFrame:
    """``(id, n_bytes, spans, kept)`` of ``(id, text, spans)``: without the bytes under strings that begin in the spans."""
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, rest = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs = merged(found or [], WIDTH - 1)
                borders = [0, *(x for run in runs for x in run), len(data)]
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in runs])
                rest.append(b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, runs_type), pa.array(rest, pa.binary())], ["id", "n_bytes", "spans", "kept"]
            )

    return texts.select("id", "text", "spans").mapInArrow(run, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``(id, text, spans)`` of the texts that have spans."""
    grouped = spans.groupBy("id").agg(F.collect_list("span").alias("spans"))  # of one text, at most its phrases
    return texts.withColumn("slot", slot("id")).join(occupied(spans, "id"), "slot", "left_semi").join(grouped, "id").select("id", "text", "spans")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``(id, start, n)``: ``n`` neighbouring string starts that occur earlier."""
    found = stored(judged(parse(texts)))
    distinct = found.where("NOT again").withColumn("span", F.struct("trigger", "start", "n"))
    many = stored(distinct.groupBy("trigger").count().where(F.col("count") > GROUP).select("trigger"))
    few = distinct if many.isEmpty() else distinct.join(many, "trigger", "left_anti")
    spans = found.where("again").select("id", "start", "n").union(ordered_suffixes(phrase_bytes(with_spans(texts, few))))
    if many.isEmpty():
        return spans
    strings = stored(suffixes(with_spans(texts, distinct.join(many, "trigger", "left_semi"))))
    where = F.struct("id", "at")
    earliest = strings.groupBy("key", "key2").agg(F.min(where).alias("first"), F.count("*").alias("times")).where("times > 1")
    partly = strings.join(earliest, ["key", "key2"]).where(where != F.col("first")).select("id", F.col("at").alias("start"), F.lit(1).cast("short").alias("n"))
    return spans.union(partly)


def numbered(docs: DataFrame) -> DataFrame:
    """``(id, text, key)`` with a number that follows the order of ``id``, rows of one id by their text."""
    rows = docs.repartitionByRange("key", F.md5(F.col("text").cast("binary"))).sortWithinPartitions("key", F.md5(F.col("text").cast("binary")))
    return stored(rows.withColumn("id", F.monotonically_increasing_id()))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, spans, kept)``: runs of bytes removed, end exclusive, and the bytes that stay.

    A byte goes if a string of 100 bytes over it begins earlier too: in a document of smaller id, or before in the same.
    Strings are judged on the input and never cross documents. A null text is empty. Where ids repeat, are null or no
    whole numbers, rows are numbered in the order of id, null first, then text, and equal rows follow one another. Other
    columns are not read. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    whole = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    plain = whole and source.groupBy("key").agg(F.count("*").alias("n")).where("n > 1 OR key IS NULL").isEmpty()
    texts = source.select(F.col("key").cast("long").alias("id"), "text") if plain else numbered(source)
    spans = stored(repeated_spans(texts)).withColumn("span", F.struct("start", "n"))
    other = texts.withColumn("slot", slot("id")).join(occupied(spans, "id"), "slot", "left_anti")
    shared = texts.withColumn("slot", slot("id")).join(occupied(spans, "id"), "slot", "left_semi")
    grouped = spans.groupBy("id").agg(F.collect_list("span").alias("spans"))
    none = F.lit(None).cast("array<struct<start:int,n:smallint>>").alias("spans")
    done = cut(shared.join(grouped, "id", "left").select("id", "text", "spans").union(other.select("id", "text", none)))
    if not plain:
        done = done.join(texts.select("id", "key"), "id").drop("id").withColumnRenamed("key", "id")
    return done.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_bytes", "spans", "kept")
