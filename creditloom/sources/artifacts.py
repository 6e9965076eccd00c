"""Listing and summarising written artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.rowexpr import artifact_type
from creditloom.sources.storage import read_parquet


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """One row per file below ``root``: key, size, time and what its path says.

    Only metadata columns of the binary source are read, never file contents.
    Partition values (``name=value`` folders) come as a map; ``partition`` picks
    one of them.
    """
    base = root.rstrip("/")
    base = base.split("://", 1)[-1] if "://" in base else base.removeprefix("file:")
    # entry 0 of the key is the last folder of the root
    parent = base.rsplit("/", 1)[0]
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    plain = F.regexp_replace("path", r"^[a-z0-9]+:(//)?", "")
    key = F.expr(f"substring(_plain, {len(parent) + 2})")
    parts = F.split("key", "/")
    name = F.element_at(parts, -1)
    pairs = F.regexp_extract_all("key", F.lit(r"(?:^|/)([A-Za-z0-9_\-]+=[^/]+)(?=/)"), 1)
    return (
        files.withColumn("_plain", plain)
        .withColumn("key", key)
        .select(
            "key",
            F.col("length").alias("size_bytes"),
            F.round(F.col("length") / F.lit(1024.0 * 1024.0), 4).alias("size_mb"),
            F.col("modificationTime").alias("last_modified"),
            F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("level_0"),
            F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise(F.lit("(none)")).alias("artifact"),
            F.coalesce(F.get(parts, F.lit(2)), F.lit("")).alias("subartifact"),
            name.alias("filename"),
            F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"),
            artifact_type("key").alias("artifact_type"),
            F.str_to_map(F.array_join(F.array_distinct(pairs), "/"), F.lit("/"), F.lit("=")).alias("partitions"),
            F.col("path"),
        )
    )


def partition(name: str) -> Column:
    """Value of a partition folder, null where the path has none."""
    return F.try_element_at(F.col("partitions"), F.lit(name))


def readable_size(size: str | Column) -> Column:
    """Bytes with two decimals in the largest unit that keeps it above one."""
    b = (F.col(size) if isinstance(size, str) else size).cast("double")
    b = F.coalesce(b, F.lit(0.0))
    out = None
    units = ["B", "KB", "MB", "GB"]
    for i, unit in enumerate(units):
        text = F.concat(F.format_number(b / F.lit(1024.0**i), 2), F.lit(f" {unit}"))
        cond = b < F.lit(1024.0 ** (i + 1))
        out = F.when(cond, text) if out is None else out.when(cond, text)
    return out.otherwise(F.concat(F.format_number(b / F.lit(1024.0**4), 2), F.lit(" TB")))


def artifact_summary(files: DataFrame, now: Column | None = None) -> DataFrame:
    """Files, bytes, last update and age in days per artifact."""
    moment = now if now is not None else F.current_timestamp()
    seconds = F.unix_timestamp(moment) - F.unix_timestamp("last_update")
    return (
        files.groupBy("artifact_type", "artifact")
        .agg(
            F.count("key").alias("files"),
            F.sum("size_bytes").alias("size_bytes"),
            F.max("last_modified").alias("last_update"),
        )
        .withColumn("size_text", readable_size("size_bytes"))
        .withColumn("age_days", F.round(seconds / F.lit(86400.0), 1))
        .orderBy("artifact_type", F.desc("size_bytes"), F.desc("files"), "artifact")
    )


def artifact_files(files: DataFrame, name: str) -> DataFrame:
    """Parquet keys whose path mentions the artifact, without marker files."""
    return (
        files.filter(F.contains(F.lower("key"), F.lit(name.lower())))
        .filter((F.col("extension") == "parquet") & ~F.startswith(F.col("filename"), F.lit("_")))
        .orderBy("key")
    )


# Names that make a file the first choice for a preview.
PREFERRED = "train_features_selected|train_final_features"


def default_artifact(files: DataFrame) -> DataFrame:
    """The file to preview first: a preferred name, else Parquet, else any;
    then the largest, then the newest."""
    choice = F.when(F.lower("key").rlike(PREFERRED), 0).when(F.col("extension") == "parquet", 1).otherwise(2)
    return files.orderBy(choice, F.desc("size_bytes"), F.desc("last_modified"), "key").limit(1)


def partition_summary(files: DataFrame, column: str) -> DataFrame:
    """Files and megabytes per value of a partition folder."""
    return (
        files.groupBy(partition(column).alias(column))
        .agg(F.count("key").alias("files"), F.round(F.sum("size_mb"), 2).alias("size_mb"))
        .orderBy(F.desc("files"), column)
    )


def artifact_rows(spark: SparkSession, files: DataFrame, name: str, column: str | None = None) -> DataFrame:
    """``artifact, column, files, rows``: rows of an artifact's Parquet files per
    value of a partition folder, counted by the file a row comes from; columns
    are not read. Empty where the artifact has no files."""
    listed = artifact_files(files, name).select("path", "artifact", (partition(column) if column else F.lit(None).cast("string")).alias(column or "partition"))
    df = read_artifact(spark, files, name)
    if df is None:
        return listed.groupBy("artifact", column or "partition").agg(F.count("path").alias("files"), F.lit(0).cast("long").alias("rows"))
    counted = df.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("n"))
    plain = F.regexp_replace(F.col("path"), r"^[a-z0-9]+:/*", "/")
    same = plain == F.regexp_replace(F.url_decode("_path"), r"^[a-z0-9]+:/*", "/")
    return listed.join(counted, same, "left").groupBy("artifact", column or "partition").agg(
        F.count("path").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows")
    )


ORDERS = {
    "newest": lambda: [F.desc("last_modified"), F.col("key")],
    "largest": lambda: [F.desc("size_bytes"), F.col("key")],
    "name": lambda: [F.col("filename"), F.col("key")],
}


def select_files(files: DataFrame, artifacts: Sequence[str] = (), extensions: Sequence[str] = (), order: str = "newest") -> DataFrame:
    out = files
    if artifacts:
        out = out.filter(F.col("artifact").isin(list(artifacts)))
    if extensions:
        out = out.filter(F.col("extension").isin(list(extensions)))
    return out.orderBy(*ORDERS[order]())


MAX_FILES_IN_READ = 10_000


def read_artifact(spark: SparkSession, files: DataFrame, name: str, n: int | None = None) -> DataFrame | None:
    """Rows of all Parquet files of an artifact, at most ``n``; ``None`` when
    it has none. A missing artifact is an answer here, a broken file an error."""
    rows = artifact_files(files, name).select("path").limit(MAX_FILES_IN_READ + 1).collect()
    if not rows:
        return None
    if len(rows) > MAX_FILES_IN_READ:
        raise ValueError(f"{name} has more than {MAX_FILES_IN_READ} files, read its folder instead")
    df = read_parquet(spark, [r["path"] for r in rows])
    return df.limit(n) if n is not None else df
