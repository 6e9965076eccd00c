"""One query per operator, at production settings, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    decontamination, hard_negatives, lexical, licenses, line_dedup, mixing, near_dedup, pii, quality, secrets, suffix_dedup,
    toxicity, url_filters,
)
from creditloom.llm.common import table
from creditloom.llm.oracle import ORACLE  # noqa: F401

#: Rules of the url query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def joined(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(spans: Column | str) -> Column:
    return F.sha2(joined(spans), 256)


def counted(kind: str, spans: Column | str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.base_failed().alias("base_failed"), quality.kept().alias("kept"), "quality", "votes",
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_removed", "text")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *(counted(k, base) for k in secrets.BASE_KINDS), digest(base).alias("base_sha256"), joined("spans").alias("spans")
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [k.name for k in pii.KINDS if k.base]
    base = F.filter("spans", lambda s: s["kind"].isin(*names))
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", *(counted(k, base) for k in names), digest(base).alias("base_sha256"), joined("spans").alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("score"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "words"
    )


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])

    def labels(spans: Column | str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    share = F.coalesce(F.try_divide("covered", "n_words"), F.lit(0.0))
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels("spans").alias("labels"), share.alias("score"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_quality_rules": op2_quality_rules,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_source_mixing": op7_source_mixing,
    "op8_personal_data": op8_personal_data,
    "op9_toxicity": op9_toxicity,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_scan": op12_license_scan,
    "op13_lexical_search": op13_lexical_search,
}
