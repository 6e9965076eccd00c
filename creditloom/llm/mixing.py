"""Mixing of sources to target weights by Poisson replication.

Every source gets a repetition rate: target share of the characters over actual share. A document of a source with rate
r occurs Poisson(r) times in the result, drawn by inverting the distribution function at a number hashed from its id, so
the draw depends on nothing but the id and the seed. Copies are then shuffled globally by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stored, unit

#: Largest mean of a single draw: larger rates are sums of several draws, so exp(-mean) keeps its digits.
DRAW_MEAN = 32.0
#: Terms of the distribution function; at the largest mean the rest is below 1e-30.
TERMS = 128
#: Sources up to which their table of about 1 KB a row is broadcast.
BROADCAST_SOURCES = 10_000
SALTS = 64


def distribution(mean: Column) -> Column:
    """P(N <= k) of a Poisson variable for k = 0 .. TERMS."""
    first = F.exp(-mean)
    state = F.struct(F.array(first).alias("cdf"), first.alias("p"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(F.array_append(s["cdf"], F.element_at(s["cdf"], -1) + p).alias("cdf"), p.alias("p"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), state, step, lambda s: s["cdf"])


def source_rates(docs: DataFrame, targets: dict[str, float] | None, epochs: float, source_col: str, text_col: str) -> DataFrame:
    """``(source, rate, draws, cdf)``: one row per source, null a source of its own.

    ``targets`` gives the wanted shares of characters, in any unit; sources it leaves out get none. Without targets all
    sources weigh the same. ``epochs`` is the size of the result over that of the input. A source without characters
    can't be weighed and keeps each row once.
    """
    sizes = stored(docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.coalesce(F.length(text_col), F.lit(0))).alias("chars")))
    if targets is None:
        weight = F.lit(1.0)
    else:
        weight = F.coalesce(F.create_map(*(F.lit(x) for pair in targets.items() for x in pair))[F.col("source")], F.lit(0.0)) if targets else F.lit(0.0)
    weighed = sizes.withColumn("weight", F.when(F.col("chars") > 0, weight))
    total = weighed.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(total["weight"] or 1.0)
    rate = F.coalesce(share * F.lit(float(total["chars"] or 0) * epochs) / F.col("chars"), F.lit(1.0))
    rates = weighed.select("source", rate.alias("rate"))
    rates = rates.withColumn("draws", F.greatest(F.ceil(F.col("rate") / DRAW_MEAN), F.lit(1)).cast("int"))
    return rates.withColumn("cdf", distribution(F.col("rate") / F.col("draws")))


def mix(
    docs: DataFrame, targets: dict[str, float] | None = None, epochs: float = 1.0, seed: int = 0, id_col: str = "doc_id",
    source_col: str = "source", text_col: str = "text", replica_col: str = "replica",
) -> DataFrame:
    """Rows of ``docs``, each as often as drawn, with ``replica_col`` from 1, in hashed order.

    All columns stay; a column already named ``replica_col`` is replaced. Rows with one id, repeated or null, share their
    draw. Null texts count no characters. An empty table gives an empty one.
    """
    rates = source_rates(docs, targets, epochs, source_col, text_col)
    columns = [c for c in docs.columns if c != replica_col]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col(id_col).cast("string").alias("id"), F.col(source_col).alias("of"))
    same = F.col("of").eqNullSafe(F.col("source"))
    if rates.count() <= BROADCAST_SOURCES:
        drawn = rows.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        drawn = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("salt") == F.col("slice")))
    key = F.lit(str(seed))

    def times(draw: Column) -> Column:
        u = unit(key, F.col("id"), draw.cast("string"))
        return F.size(F.filter("cdf", lambda c: c <= u))

    rest = F.aggregate(F.sequence(F.lit(2), F.col("draws")), F.lit(0), lambda n, draw: n + times(draw))
    count = times(F.lit(1)) + F.when(F.col("draws") > 1, rest).otherwise(0)
    copies = drawn.withColumn("n", count).where("n > 0").select("row", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    shuffled = copies.withColumn("at", unit(F.lit("order"), key, F.col("id"), F.col("copy").cast("string"))).repartition("at").sortWithinPartitions("at")
    return shuffled.select(*(F.col("row").getField(c).alias(c) for c in columns), F.col("copy").alias(replica_col))
