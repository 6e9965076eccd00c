"""Lake zones, table and file readers, writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators.cleaning import normalize_columns
from creditloom.shared import delete_path, materialize, shared_folder  # noqa: F401

ZONES = ("raw", "trusted", "refined")


@dataclass(frozen=True)
class Catalog:
    """Where tables live: a path per zone and the databases to look in, most
    preferred first. Paths that differ from ``zone/name`` go to ``locations``."""

    root: str
    databases: tuple[str, ...] = ("trusted_db", "raw_db")
    locations: Mapping[tuple[str, str], str] = field(default_factory=dict)
    path_fallback: bool = True

    def path(self, zone: str, name: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone: {zone}")
        return self.locations.get((zone, name), f"{self.root.rstrip('/')}/{zone}/{name.strip('/')}")


def read_table(
    spark: SparkSession, name: str, catalog: Catalog, zone: str = "raw", schema: T.StructType | None = None
) -> DataFrame:
    """First catalog database that knows the table, else its path: Parquet, or
    CSV where the path holds no Parquet. Column names come out normalised."""
    for database in catalog.databases:
        if spark.catalog.databaseExists(database) and spark.catalog.tableExists(f"{database}.{name}"):
            return normalize_columns(spark.table(f"{database}.{name}"))
    if not catalog.path_fallback:
        raise LookupError(f"{name} is in none of {catalog.databases} and path fallback is off")
    path = catalog.path(zone, name)
    try:
        return normalize_columns(read_parquet(spark, path))
    except (AnalysisException, Py4JJavaError) as error:
        # files that are not Parquet: no schema to infer, or no readable footer
        if not any(sign in str(error) for sign in ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER")):
            raise
    return normalize_columns(read_csv(spark, path, schema))


def load_tables(spark: SparkSession, names: Sequence[str], catalog: Catalog, required: Sequence[str] = ()) -> dict[str, DataFrame | None]:
    """Read and register tables; an absent optional one is ``None``."""
    out: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            out[name] = register(read_table(spark, name, catalog), name)
        except (AnalysisException, LookupError) as error:
            # anything else than a table or path that is not there is a fault
            absent = isinstance(error, LookupError) or any(sign in str(error) for sign in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"))
            if name in required or not absent:
                raise
            out[name] = None
    return out


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",", header: bool = True
) -> DataFrame:
    """CSV with a header. With a schema, text that does not parse becomes null;
    without one the types are inferred, which reads the files twice."""
    reader = spark.read.options(header=header, sep=sep, nullValue="", nanValue="NaN", mode="PERMISSIVE")
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".ndjson": "json"}


def preview_file(spark: SparkSession, path: str, n: int = 500) -> DataFrame:
    """First rows of a csv, parquet, json or json-lines file. Columns of a csv
    file are text, as finding their types would read all of it."""
    ext = path[path.rfind("."):].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if ext not in FORMATS:
        raise ValueError(f"unsupported format for preview: {ext or path}")
    if ext == ".csv":
        return spark.read.options(header=True, nullValue="").csv(path).limit(n)
    reader = spark.read.format(FORMATS[ext])
    if ext == ".json":
        reader = reader.option("multiLine", True)
    return reader.load(path).limit(n)


def preview(source: DataFrame | str, n: int = 10, spark: SparkSession | None = None) -> DataFrame:
    """Row preview of a table, or of a file given by path."""
    if isinstance(source, DataFrame):
        return source.limit(n)
    return preview_file(spark or SparkSession.active(), source, n)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_csv_table(spark: SparkSession, name: str, schema: T.StructType, location: str, sep: str = ",") -> None:
    """External delimited-text table: header line skipped, empty text is null,
    text that does not parse is null."""
    spark.sql(
        f"CREATE TABLE {_quoted(name)} ({_ddl(schema)}) USING csv "
        f"OPTIONS (header 'true', sep {_literal(sep)}, nullValue '', mode 'PERMISSIVE') LOCATION {_literal(location)}"
    )


def create_parquet_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                         partition_by: Sequence[str] = ()) -> None:
    """External Parquet table; partition columns are declared as such and the
    existing partitions are registered."""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {_quoted(name)} ({_ddl(schema)}) USING parquet{parts} LOCATION {_literal(location)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


@dataclass
class OutputRegistry:
    """Written outputs by name with rows, columns and path. Rows are observed
    during the write, so nothing is counted again."""

    entries: dict[str, tuple[int, int, str]] = field(default_factory=dict)

    def report(self, spark: SparkSession) -> DataFrame:
        rows = [(n, r, c, p) for n, (r, c, p) in self.entries.items()]
        return spark.createDataFrame(rows, "dataset string, row_count bigint, column_count int, output_path string")


def write_parquet(
    df: DataFrame,
    catalog: Catalog,
    zone: str,
    name: str,
    partition_by: str | Sequence[str] = (),
    registry: OutputRegistry | None = None,
    allowed_zones: Sequence[str] = ("trusted", "refined"),
    overwrite_partitions: bool = False,
    cluster: bool = True,
) -> DataFrame:
    """Overwrite a Parquet output of a zone and read it back.

    Zones outside ``allowed_zones`` are refused. For partitioned outputs the
    rows are first brought together per partition value and file count is left
    to adaptive execution, which splits a large value over several tasks;
    ``overwrite_partitions`` replaces only partitions present in ``df``.
    """
    if zone not in allowed_zones:
        raise PermissionError(f"writing to zone {zone} is not allowed here")
    path = catalog.path(zone, name)
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    out = df
    if cols and cluster:
        out = out.hint("rebalance", *cols)
    seen = Observation()
    if registry is not None:
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if cols:
        writer = writer.partitionBy(*cols)
    if overwrite_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    if registry is not None:
        registry.entries[name] = (int(seen.get["rows"]), len(df.columns), path)
    return df.sparkSession.read.parquet(path)


def write_report(df: DataFrame, catalog: Catalog, name: str, zone: str = "refined") -> str:
    """Single CSV file with a header; only for small aggregates."""
    path = catalog.path(zone, name)
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
    return path
