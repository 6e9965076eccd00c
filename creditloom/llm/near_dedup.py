"""Near duplicates by MinHash with sequential Bayesian verification.

A document is the set of its distinct five-word shingles. Documents with one set are one node from the start. MinHash
bands propose pairs; a pair's signatures are compared batch by batch, and it is dropped as soon as the posterior
probability that its similarity reaches the threshold falls below the chosen miss probability. What survives is checked
on the full sets.

No bucket is paired with itself; ``components.settled`` says how all proposed links are still found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import map_batches, occupied, slot, stored
from creditloom.llm.components import components, settled

WIDTH = 5
#: Percent of the union that the intersection must reach.
SIMILARITY = 75
#: At the threshold a pair shares no band with probability (1 - 0.75 ** 4) ** 24, about 1e-4.
BANDS, ROWS = 24, 4
#: Hash values compared at a time.
BATCH = 16
#: Probability of dropping a pair that reaches the threshold, per comparison.
MISS = 1e-4
#: Nodes on each side of a block.
BLOCK = 256
#: Shingles hashed at a time, bounding the memory of a long text.
CHUNK = 1 << 13

_random = np.random.default_rng(20240229)
MULTIPLIERS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the shingles; a text of fewer than five words is one shingle."""
    words = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "").encode("utf-8", "surrogatepass").split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    width = min(WIDTH, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total = mixed(total * MIX + hashed[i : n - width + 1 + i])
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    best = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        for j, (a, b) in enumerate(zip(MULTIPLIERS, OFFSETS, strict=True)):
            best[j] = min(best[j], (part * a + b).min())
    return (best >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(values[i * ROWS : (i + 1) * ROWS].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, hash, n_shingles, node, values, bands)``: ``hash`` is that of the text, ``node`` a 128-bit digest of the set,
    null for an empty one."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"id": batch.column(0), "hash": batch.column(2), "n_shingles": [], "node": [], "values": [], "bands": []}
        for text in batch.column(1).to_pylist():
            found = shingle_set(text)
            values = signature(found) if len(found) else None
            out["n_shingles"].append(len(found))
            out["node"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            out["values"].append(None if values is None else values.tobytes())
            out["bands"].append(None if values is None else band_keys(values))
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    return map_batches(source, rows, f"id {kind}, hash long, n_shingles long, node binary, values binary, bands array<long>")


def least_matches(threshold: float = SIMILARITY / 100, miss: float = MISS) -> list[int]:
    """Matches needed after each batch: with fewer, P(similarity >= threshold) < ``miss`` under a uniform prior."""
    needed = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)  # posterior mass above the threshold
            if tail >= miss:
                break
        needed.append(m)
    return needed


def survivors(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that no batch of hash values rules out."""
    needed = least_matches()

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        left, right = (np.array([np.frombuffer(v, np.uint32) for v in batch.column(i).to_pylist()]).reshape(-1, BANDS * ROWS) for i in (2, 3))
        alive, matches = np.arange(len(left)), np.zeros(len(left), int)
        for k, least in enumerate(needed):
            cut = slice(k * BATCH, (k + 1) * BATCH)
            matches[alive] += (left[alive, cut] == right[alive, cut]).sum(axis=1)
            alive = alive[matches[alive] >= least]
        kept = pa.array(alive)
        return {"a": batch.column(0).take(kept), "b": batch.column(1).take(kept)}

    first, second = signed.select(F.col("node").alias("a"), F.col("values").alias("va")), signed.select(F.col("node").alias("b"), F.col("values").alias("vb"))
    return map_batches(pairs.join(first, "a").join(second, "b").select("a", "b", "va", "vb"), rows, "a binary, b binary")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        sets: dict[bytes, np.ndarray] = {}
        kept = []
        for i, (a, b, left, right) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
            for node, text in ((a, left), (b, right)):
                if node not in sets:
                    if len(sets) >= 64:
                        sets.clear()
                    sets[node] = shingle_set(text)
            x, y = sets.get(a), sets.get(b)
            x, y = shingle_set(left) if x is None else x, shingle_set(right) if y is None else y
            if alike(x, y):
                kept.append(i)
        chosen = pa.array(kept, pa.int64())
        return {"a": batch.column(0).take(chosen), "b": batch.column(1).take(chosen)}

    first, second = texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return map_batches(pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb"), rows, "a binary, b binary")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first three columns, cut into runs of equal ones; a run is a block of bounded size."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        keys = [rows.column(i).to_numpy() for i in range(3)]
        ends = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        for first, last in zip([0, *ends], ends, strict=False):
            yield rows.slice(first, last - first)
        rest = rows.slice(ends[-1] if len(ends) else 0)
    if rest is not None and rest.num_rows:
        yield rest


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([np.frombuffer(v, np.uint32) for v in column.to_pylist()]).reshape(-1, BANDS * ROWS)


def block_survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block the nodes with pairs that no batch of hash values rules out, and those pairs as lists.

    A pair is looked at in the first band it shares only.
    """
    needed = least_matches()
    for rows in runs(batches):
        index, outside, in_main = rows.column("index")[0].as_py(), rows.column("outside").to_numpy(), rows.column("in_main").to_numpy()
        nodes, owners = np.array(rows.column("node").to_pylist(), object), np.array(rows.column("component").to_pylist(), object)
        values, sizes = matrix(rows.column("values")), rows.column("n_shingles").to_numpy()
        left, right = np.flatnonzero(outside), np.flatnonzero(~outside)
        found: dict[int, set[bytes]] = {}
        for x in left:
            near = right[(owners[right] != owners[x]) & (in_main[right] | (nodes[right] > nodes[x]))]
            near = near[100 * np.minimum(sizes[near], sizes[x]) >= SIMILARITY * np.maximum(sizes[near], sizes[x])]
            matches = np.zeros(len(near), int)
            for k, least in enumerate(needed):
                cut = slice(k * BATCH, (k + 1) * BATCH)
                matches += (values[near, cut] == values[x, cut]).sum(axis=1)
                near, matches = near[matches >= least], matches[matches >= least]
            if len(near):
                bands = (values[near] == values[x]).reshape(-1, BANDS, ROWS).all(axis=2)
                near = near[bands.argmax(axis=1) == index]
            if len(near):
                found[x] = set(nodes[near])
                for y in near:
                    found.setdefault(y, set())
        if found:
            picked = pa.array(list(found), pa.int64())
            partners = pa.array([sorted(v) for v in found.values()], pa.list_(pa.binary()))
            block = [rows.column(c).take(picked).combine_chunks() for c in ("band", "i", "j", "node")]
            yield pa.RecordBatch.from_arrays([*block, partners], ["band", "i", "j", "node", "partners"])


def block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a block whose full sets reach the threshold."""
    for rows in runs(batches):
        sets: dict[bytes, np.ndarray] = {}
        lists: dict[bytes, set[bytes]] = {}
        for node, partners, text in zip(*(rows.column(c).to_pylist() for c in ("node", "partners", "text")), strict=True):
            if node not in sets:
                sets[node] = shingle_set(text)
            lists.setdefault(node, set()).update(partners)
        pairs = [sorted((x, y)) for x, ys in lists.items() for y in ys if alike(sets[x], sets[y])]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= SIMILARITY * (len(x) + len(y) - shared)


def crossing_links(live: DataFrame, near: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components of a bucket, found in blocks of about ``BLOCK`` by ``BLOCK`` nodes.

    The nodes outside a bucket's largest component meet all others. Blocks are compared where they are, so no row is
    made for a pair that is not a link.
    """
    sizes = live.groupBy("band", "component").count()
    main = F.max_by("component", F.struct("count", "component")).alias("main")
    opened = sizes.groupBy("band").agg(main, F.max("count").alias("most"), F.sum("count").alias("total"), F.count("*").alias("n")).where("n > 1")
    members = live.join(opened, "band").join(near.select("node", "values", "n_shingles"), "node")
    members = members.withColumn("in_main", F.col("component") == F.col("main"))
    members = members.withColumn("outs", F.ceil((F.col("total") - F.col("most")) / BLOCK).cast("int")).withColumn("ins", F.ceil(F.col("total") / BLOCK).cast("int"))
    columns = ["band", "i", "j", "outside", "index", "in_main", "node", "component", "values", "n_shingles"]
    place = F.xxhash64("node")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    out = members.where("NOT in_main").withColumn("outside", F.lit(True)).withColumn("i", F.pmod(place, "outs").cast("int")).withColumn("j", every("ins"))
    inside = members.withColumn("outside", F.lit(False)).withColumn("j", F.pmod(place, "ins").cast("int")).withColumn("i", every("outs"))
    key = ["band", "i", "j"]
    blocks = out.select(columns).union(inside.select(columns)).repartition(*key).sortWithinPartitions(*key)
    left = stored(blocks.mapInArrow(block_survivors, "band long, i int, j int, node binary, partners array<binary>"))
    again = left.join(texts, "node").select(*key, "node", "partners", "text").repartition(*key).sortWithinPartitions(*key)
    return again.mapInArrow(block_links, "a binary, b binary").distinct()


def link(signed: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(node, component)`` of the nodes that are linked with another."""
    first = [F.first(c).alias(c) for c in ("values", "bands", "n_shingles")]
    nodes = stored(signed.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), *first))
    buckets = nodes.select("node", F.posexplode("bands").alias("index", "band"))
    shared = buckets.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    live = stored(buckets.join(shared, "band"))
    degree = live.groupBy("node").agg(F.sum("size").alias("degree"))
    near = stored(nodes.join(degree, "node").select("node", "id", "values", "degree", "n_shingles"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    picked = source.withColumn("slot", slot("id")).join(occupied(near, "id"), "slot", "left_semi")
    texts = stored(with_node(picked).join(near.select("node"), "node", "left_semi").dropDuplicates(["node"]))
    live = stored(live.join(near.select("node", "degree"), "node").withColumn("component", F.col("node")))
    edges = settled(live, lambda pairs: confirmed(survivors(pairs, near), texts), lambda open_: crossing_links(open_, near, texts))
    if edges is None:
        return signed.select("node", F.col("node").alias("component")).limit(0)
    return components(edges).withColumnRenamed("id", "node")


def with_node(texts: DataFrame) -> DataFrame:
    """``(node, text)``: rows that repeat an id, or have none, find their own set."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column(0)
        return {"node": [hashlib.blake2b(shingle_set(t).tobytes(), digest_size=16).digest() for t in texts.to_pylist()], "text": texts}

    return map_batches(texts.select("text"), rows, "node binary, text string")


def joined(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, hash, n_shingles, node, component)`` of every row; no component for an empty set."""
    signed = stored(signatures(docs, id_col, text_col))
    linked = stored(link(signed, docs, id_col, text_col))
    rows = signed.select("id", "hash", "n_shingles", "node").join(linked, "node", "left")
    return rows.withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, one row per input row.

    ``component_id`` is the least id reachable over links of similarity 0.75 or more, the row's own included; a row is
    kept if it has that id. A null or empty text has an empty set, is linked with nothing and kept. Rows that repeat an
    id keep their own sets and share the id. A null id is never the least; a component of null ids has a null
    ``component_id`` and its rows are kept. Other columns are not read. An empty table gives an empty result.
    """
    rows = joined(docs, id_col, text_col)
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    out = rows.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are: one of each component, that of least id.

    A row is known by its id and the hash of its text, so unlike texts under one id all stay, and rows that repeat both
    are one. Texts without words are linked with nothing, and rows of a null id have no name to be chosen by: all of
    these stay. An empty table gives an empty result.
    """
    rows = joined(docs, id_col, text_col).where("component IS NOT NULL AND id IS NOT NULL")
    named = rows.groupBy("component", "id", "hash").agg(F.min("node").alias("node"), F.count("*").alias("count"))
    first = named.groupBy("component").agg(F.min(F.struct("id", "node", "hash")).alias("first"))
    gone = ((F.col("id") != F.col("first.id")) | (F.col("hash") != F.col("first.hash"))).alias("gone")
    touched = stored(named.join(first, "component").select("id", "hash", gone, "count").where("gone OR count > 1").select("id", "hash", "gone"))

    text = F.col(text_col).cast("string")
    columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    marked = docs.select(columns, F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash")).withColumn("slot", slot("_hash"))
    slots = occupied(touched, "hash")
    untouched = marked.join(slots, "slot", "left_anti")
    maybe = marked.join(slots, "slot", "left_semi").join(touched, (F.col("_id") == F.col("id")) & (F.col("_hash") == F.col("hash")), "left")
    repeated = maybe.where("NOT gone").dropDuplicates(["_id", "_hash"])
    return untouched.select("row.*").union(maybe.where("gone IS NULL").select("row.*")).union(repeated.select("row.*"))
