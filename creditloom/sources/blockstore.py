"""Feature blocks kept as bucketed tables, joined without moving them.

Every block has one row per entity and is written hashed and sorted by the
entity key into the same number of buckets, one file each. Blocks that are
joined on the key then meet bucket by bucket: no exchange, whatever their size.
A block is replaced alone; readers see the old version or the new one, never a
mixture.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from creditloom.operators.joins import assemble_master
from creditloom.shared import delete_path
from creditloom.sources.storage import _literal, _quoted


@dataclass(frozen=True)
class BlockStore:
    """Blocks of one entity key below ``root``, a folder all executors share.

    ``database`` holds a table per version and, under the block's own name, a
    view of the current one. ``buckets`` is fixed for the life of the store:
    blocks with different numbers of buckets would have to be shuffled again.
    """

    spark: SparkSession
    root: str
    database: str
    key: str
    buckets: int

    def __post_init__(self) -> None:
        if self.buckets < 1:
            raise ValueError("a store needs at least one bucket")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.database)} LOCATION {_literal(f'{self.root}/{self.database}')}")

    def _check(self, name: str) -> str:
        if not re.fullmatch(r"[a-z][a-z0-9_]*", name) or "__v" in name:
            raise ValueError(f"not a block name: {name}")
        return name

    def write(self, name: str, block: DataFrame) -> str:
        """Write a new version of a block and make it the current one; its table name.

        The block must have one row per key (it comes out of ``groupBy(key)``).
        Rows are brought together by the bucket hash, so every bucket is one
        sorted file. The view changes only when the files are complete: a failed
        write leaves the old version in place.
        """
        table = f"{self._check(name)}__v{uuid.uuid4().hex[:12]}"
        full = f"{self.database}.{table}"
        (
            block.repartition(self.buckets, self.key)
            .write.bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .option("path", f"{self.root}/{self.database}/{name}/{table}")
            .saveAsTable(full, format="parquet")
        )
        self.spark.sql(f"CREATE OR REPLACE VIEW {_quoted(f'{self.database}.{name}')} AS SELECT * FROM {_quoted(full)}")
        return table

    def names(self) -> list[str]:
        rows = self.spark.sql(f"SHOW VIEWS IN {_quoted(self.database)}").collect()
        return sorted(r["viewName"] for r in rows if not r["isTemporary"])

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{self._check(name)}")

    def current(self, name: str) -> str:
        """Table of the current version."""
        text = self.spark.sql(f"SHOW CREATE TABLE {_quoted(f'{self.database}.{self._check(name)}')}").first()[0]
        return re.search(r"\w+__v[0-9a-f]{12}", text)[0]

    def versions(self) -> DataFrame:
        """``block, version, is_current`` of every stored version."""
        tables = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {_quoted(self.database)}").collect()]
        live = {self.current(n) for n in self.names()}
        rows = [(t.rsplit("__v", 1)[0], t, t in live) for t in sorted(tables) if "__v" in t]
        return self.spark.createDataFrame(rows, "block string, version string, is_current boolean")

    def vacuum(self) -> int:
        """Drop all versions but the current ones, with their files; how many.
        Call it when no job still reads an older version."""
        old = [r for r in self.versions().collect() if not r["is_current"]]
        for r in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(f'{self.database}.{r['version']}')}")
            delete_path(self.spark, f"{self.root}/{self.database}/{r['block']}/{r['version']}")
        return len(old)

    def drop(self) -> None:
        """Remove the store: views, tables and files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {_quoted(self.database)} CASCADE")
        delete_path(self.spark, f"{self.root}/{self.database}")

    def assemble(self, base: str, blocks: Sequence[str], expected: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
        """Left join of blocks to ``base``, bucket by bucket.

        The hint keeps the planner from sending a small block to every task,
        which would cost more than reading it where it is. A block that is not
        in the store gives the typed null columns declared in ``expected``.
        """
        held = set(self.names())
        missing = [b for b in blocks if b not in held and b not in (expected or {})]
        if base not in held or missing:
            raise LookupError(f"not in the store: {missing or base}")
        parts = {b: self.read(b).hint("merge") if b in held else None for b in blocks}
        return assemble_master(self.read(base), parts, self.key, expected)

