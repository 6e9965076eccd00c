"""Tables, stored intermediate results and text pieces that several operators share."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.shared import delete_path, shared_folder

#: The six ASCII characters that end a word.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Setting under which Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs the files it was writing, and later steps read the table instead of
    running its plan again. That plan's shuffle files are not needed any more and go at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads; what was made from them has to be stored by now."""
    for table in tables:
        delete_path(table.sparkSession, table._stored_at)


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast of an object whose class executors may not have; call the result inside a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


#: Rows that a task turns into Python objects at a time.
SLICE = 2048


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """``rows`` applied to each Arrow batch of ``df``; it returns columns as lists, in the order of ``schema``."""
    fields = df.sparkSession.createDataFrame([], schema).schema

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):  # texts can be long: only so many are objects at a time
                out = rows(batch.slice(at, SLICE))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


#: Slots of the set of ids that tells which rows a join can touch: a fixed size, at most 16 MB.
SLOTS = 1 << 20


def slot(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("slot")


def occupied(df: DataFrame, key: Column | str) -> DataFrame:
    """The slots of ``key``, at most ``SLOTS`` rows, to broadcast. Rows in other slots can't meet ``df`` and stay where they are."""
    return F.broadcast(df.select(slot(key)).distinct())


def unit(*parts: Column | str) -> Column:
    """Uniform number in [0, 1) from the md5 of the parts, 52 bits; any engine with md5 gives the same."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
