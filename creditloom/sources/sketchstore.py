"""Medians over many loads from stored sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.sketches import SKETCH_SIZE, merged_sketch, rank_error, sketched_count, sketched_quantile, value_sketch
from creditloom.shared import delete_path


@dataclass(frozen=True)
class SketchStore:
    """Sketches per entity and load below ``path``, a folder all executors share.

    A load is a folder with one row per entity: the keys and a binary sketch per
    measure. ``keys`` may be empty for one row per load. Load ids sort as text.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    size: int = SKETCH_SIZE

    def _folder(self, load_id: str) -> str:
        # the letter keeps the value text when the folders are read
        return f"{self.path}/load_id=L{load_id}"

    def append(self, load_id: str, rows: DataFrame, values: Mapping[str, Column]) -> None:
        """Sketch the rows of a load; loading it again replaces it alone, so a
        repeated load counts once. One aggregate with partial sketches per task:
        an entity with most of the rows arrives as one sketch per task."""
        if set(values) != set(self.measures):
            raise ValueError(f"measures of the store are {list(self.measures)}")
        sketches = [value_sketch(values[m], self.size).alias(m) for m in self.measures]
        grouped = rows.groupBy(*self.keys).agg(*sketches) if self.keys else rows.agg(*sketches)
        grouped.write.mode("overwrite").parquet(self._folder(load_id))

    def loads(self) -> DataFrame:
        """All stored sketches; a store without loads raises."""
        try:
            return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/load_id=*")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            raise LookupError(f"no loads in {self.path}") from error

    def merged(self, since: str | None = None, upto: str | None = None) -> DataFrame:
        """``keys``, ``loads`` and one merged sketch per measure, over all loads
        or those whose ids lie in the range; other loads are not read."""
        rows = self.loads()
        if since is not None:
            rows = rows.filter(F.col("load_id") >= f"L{since}")
        if upto is not None:
            rows = rows.filter(F.col("load_id") <= f"L{upto}")
        merged = [merged_sketch(m, self.size).alias(m) for m in self.measures]
        count = F.count(F.lit(1)).alias("loads")
        return rows.groupBy(*self.keys).agg(count, *merged) if self.keys else rows.agg(count, *merged)

    def quantiles(self, q: float = 0.5, suffix: str = "_median", **span: str) -> DataFrame:
        """``keys`` and the quantile of every measure."""
        values = [sketched_quantile(m, q).alias(f"{m}{suffix}") for m in self.measures]
        return self.merged(**span).select(*self.keys, *values)

    def compact(self, into: str) -> None:
        """Merge all loads into the one named ``into``; the others go. Reads the
        sketches only; run it when no job reads the store."""
        ids = [r["load_id"].removeprefix("L") for r in self.loads().select("load_id").distinct().collect()]
        staged = f"{self.path}/_compacting"
        self.merged().drop("loads").write.mode("overwrite").parquet(staged)
        for old in ids:
            delete_path(self.spark, self._folder(old))
        self.spark.read.parquet(staged).write.mode("overwrite").parquet(self._folder(into))
        delete_path(self.spark, staged)


def sketch_report(merged: DataFrame, rows: DataFrame, values: Mapping[str, Column], qs: Sequence[float], size: int = SKETCH_SIZE) -> DataFrame:
    """``measure, q, n, estimate, true_rank, rank_error, stated_error, within``.

    Holds a one-row frame of merged sketches against the rows themselves, in one
    aggregate over them. The estimate is right if ``q`` lies between the shares
    of rows below and up to it, each widened by the stated error.
    """
    names = list(values)
    asked = [
        F.struct(F.lit(m).alias("measure"), F.lit(float(q)).alias("q"), sketched_count(m).alias("n"), sketched_quantile(m, q).alias("estimate"))
        for m in names
        for q in qs
    ]
    estimates = merged.select(F.inline(F.array(*asked)))
    long = rows.select(*[values[m].cast("double").alias(m) for m in names]).unpivot([], names, "measure", "value").filter(F.col("value").isNotNull())
    below, upto = F.count_if(F.col("value") < F.col("estimate")), F.count_if(F.col("value") <= F.col("estimate"))
    met = long.join(F.broadcast(estimates), "measure").groupBy("measure", "q", "n", "estimate").agg(
        F.count(F.lit(1)).alias("_rows"), below.alias("_below"), upto.alias("_upto")
    )
    total = F.col("_rows").cast("double")
    low, high = F.col("_below") / total, F.col("_upto") / total
    error = F.greatest(low - F.col("q"), F.col("q") - high, F.lit(0.0))
    stated = F.lit(rank_error(size))
    return met.select(
        "measure", "q", "n", "estimate", high.alias("true_rank"), error.alias("rank_error"), stated.alias("stated_error"),
        ((error <= stated) & (F.col("n") == F.col("_rows"))).alias("within"),
    )
