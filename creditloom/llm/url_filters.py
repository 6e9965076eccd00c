"""URL rules as intervals of reversed-host keys, joined with the urls by one sorted sweep.

A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's. Written as
reversed host + separator + path (``org.example`` + U+0001 + ``/es/``), a rule is an interval of keys: all that start
with it. A url asks once for each of its host's ancestors that a rule could name. Rules and questions are sorted
together over range partitions; going through them in order, the rules that are open form a stack, as intervals of
prefixes nest. The rule opened last brings the stack below it, so the longest open rule at a question is the deepest of
that stack that is still a prefix of the key. Where a range partition begins inside open rules, the last rule before it
is handed in: one row per partition.

Ties in the sort are broken by the row, so a host with a third of all urls spreads over many range partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.common import stored

SEPARATOR = "\x01"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column | str) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column | str) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_labels(host: Column | str) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_table(rules: DataFrame) -> DataFrame:
    """``(key, rule, verdict, stack)`` of rules ``(host, path, verdict)``.

    ``stack`` holds the rules whose interval contains this one's, outermost first, itself last. Of equal rules the one
    that blocks wins. A rule without a host fits nothing. Null paths count as empty.
    """
    known = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .where("host <> ''")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat(F.array_join(reversed_labels("host"), "."), F.lit(SEPARATOR), "path"))
        .withColumn("rule", F.concat("host", "path"))
    )
    entry = F.struct(F.length("rule").alias("size"), "key", "rule", "verdict")
    outer = known.select(F.col("key").alias("outer_key"), entry.alias("entry"))
    begins = F.sequence(F.lit(0), F.length("path"))
    inner = known.select("key", F.explode(F.transform(begins, lambda n: F.concat(F.expr("left(key, length(key) - length(path))"), F.col("path").substr(F.lit(1), n)))).alias("outer_key"))
    return inner.join(outer, "outer_key").groupBy("key").agg(F.array_sort(F.collect_list("entry")).alias("stack"))


def questions(urls: DataFrame, id_col: str, depth: int) -> DataFrame:
    """One row per url and ancestor host of at most ``depth`` labels."""
    labels = reversed_labels("host")
    upto = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))
    keys = F.transform(upto, lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(SEPARATOR), F.col("path")))
    return urls.select("row", F.explode(keys).alias("key"))


def longest_open(rules: DataFrame, asked: DataFrame) -> DataFrame:
    """``(row, hit)`` for each question: the innermost rule whose interval holds its key, or null."""
    empty = F.lit(None).cast(rules.schema["stack"].dataType)
    events = rules.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("row"), "stack").unionByName(
        asked.select("key", F.lit(1).alias("kind"), "row", empty.alias("stack"))
    )
    ordered = stored(events.repartitionByRange("key", "kind", "row").withColumn("part", F.spark_partition_id()))
    last = ordered.where("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("last"))
    parts = ordered.select("part").distinct().join(last, "part", "left")  # one row per range partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stack = F.coalesce(F.last("stack", ignorenulls=True).over(sweep), "carried")
    opened = ordered.join(F.broadcast(carried), "part").withColumn("open", stack).where("kind = 1")
    return opened.select("row", F.try_element_at(F.filter("open", lambda r: F.col("key").startswith(r["key"])), F.lit(-1)).alias("hit"))


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` for each row of ``urls``.

    The longest rule wins; between rules of one length the deeper host. Without a rule ``rule`` is null and the verdict
    is ``default``. A null url, or one without ``://``, has an empty host and path and no rule. Repeated rows and null
    ids each keep their row; other columns are not read. An empty rule table gives everybody the default.
    """
    spark: SparkSession = urls.sparkSession
    known = stored(rule_table(rules))
    depth = known.agg(F.max(F.size(F.split(F.substring_index("key", SEPARATOR, 1), r"\.")))).first()[0] or 0
    parsed = urls.select(F.col(id_col).alias("id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    named = stored(parsed.withColumn("row", F.monotonically_increasing_id()))  # a row number holds once it is written
    hits = longest_open(known, questions(named, "row", depth)) if depth else spark.createDataFrame([], "row long, hit struct<size:int,key:string,rule:string,verdict:string>")
    best = hits.where("hit IS NOT NULL").groupBy("row").agg(F.max("hit").alias("hit"))
    return named.join(best, "row", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict")
    )
