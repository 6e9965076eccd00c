"""Training-data pipeline over ``documents``: quality, lines, near duplicates, benchmark, mixture.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. ``run`` writes each stage as
Parquet in the shared folder and reads it again. All stages return the columns of ``documents``; the last adds
``replica``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import decontamination, line_dedup, mixing, near_dedup, quality
from creditloom.llm.common import stored, table

#: No SQL can express the fitted model of the first stage; tests hold every stage against a plain version.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of 50 words or more, at most half of them repeated, that are more likely good than bad.

    Null texts have no words and go. Rows equal in id and text are judged alike.
    """
    return quality.keep(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; ``n_chars``, where there is one, is that of the new text.

    Documents that lose all their lines go. A null text stays as it is, as does one without repeated lines; rows equal
    in id and text are cut alike. An empty table stays empty.
    """
    removed = "_removed"
    while removed in docs.columns:
        removed += "_"
    done = line_dedup.dedup(docs, removed_col=removed)
    emptied = (F.col(removed) > 0) & (F.trim("text") == "")
    out = done.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out.select(*(f"`{c}`" for c in docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of least id, once if rows repeat it.

    Null texts and those without words are like nothing and stay, as do rows without an id. An empty table stays empty.
    """
    return near_dedup.keep(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; null and empty texts contain none. Repeated rows are judged alike."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in equal shares of characters, each document as often as drawn, shuffled.

    A null source is a source; rows that repeat an id are drawn alike; an empty table stays empty.
    """
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
