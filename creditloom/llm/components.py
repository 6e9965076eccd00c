"""Connected components by distributed union-find, and the links of buckets without pairing buckets with themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import release, stored

#: Rounds in which every node of a bucket meets one other; at most three differ.
ROUNDS = 3


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every end of ``edges (a, b)``; ``component`` is the least id that can be reached.

    Each round gives every node the least label among its neighbours and then follows that label once, so the number of
    rounds goes with the logarithm of the longest path. Labels are written to the shared folder after each round. A node
    with any number of edges is pre-aggregated before its rows meet. Rows with a null end are no edges.
    """
    ends = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = stored(ends.union(ends.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        old = labels.select("id", "component")
        seen = both.join(old.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("least"))
        hooked = stored(old.join(seen, "id").select("id", F.least("component", "least").alias("component"), F.col("component").alias("was")))
        target = hooked.select(F.col("id").alias("component"), F.col("component").alias("next"))
        release(labels)
        labels = stored(hooked.join(target, "component").select("id", F.least("component", "next").alias("component"), "was"))
        release(hooked)
        if labels.where("component <> was").isEmpty():
            release(both)
            return labels.select("id", "component")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def met(live: DataFrame, turn: int) -> DataFrame:
    """Pairs of each node with one of its bucket: by degree, by least node, then by a hash of the turn."""
    key = [F.struct("degree", "node"), F.struct(F.col("node")), F.struct(F.xxhash64("node", F.lit(turn)), "node")][min(turn, 2)]
    chosen = live.groupBy("band").agg(F.max_by(F.struct("node", "component"), key).alias("other"))
    other = live.join(chosen, "band").where("component <> other.component")
    return other.select(*ordered(F.col("node"), F.col("other.node"))).distinct()


def settled(live: DataFrame, confirm: Callable[[DataFrame], DataFrame], cross: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS) -> DataFrame | None:
    """Confirmed links ``(a, b)`` that connect all nodes which any chain of confirmed pairs within buckets connects.

    ``live`` has a row ``(band, node, degree, component)`` for each bucket a node is in, ``component`` being the node at
    first; ``confirm`` keeps the pairs ``(a, b)`` that are links. In each round every node of a bucket meets one node of
    it (the best connected, the least, then a hashed choice), links found are contracted to components, and only nodes
    of different components go on. Last, ``cross`` lets the nodes outside a bucket's largest component meet the nodes of
    its other components, which leaves no pair of two components in one bucket unseen. ``None`` if there is no link.
    """
    tried = edges = own = None
    for turn in range(rounds):
        pairs = met(live, turn)
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        found = stored(confirm(pairs))
        if found.isEmpty():
            continue
        edges = found if edges is None else edges.union(found)
        labels = components(edges).withColumnsRenamed({"id": "node", "component": "least"})
        joined = stored(live.join(labels, "node", "left").withColumn("component", F.coalesce("least", "node")).drop("least"))
        if own is not None:
            release(own)
        live = own = joined
    found = stored(cross(live))
    if own is not None:
        release(own)
    if found.isEmpty():
        return edges
    return found if edges is None else edges.union(found)
