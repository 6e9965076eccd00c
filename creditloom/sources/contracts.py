"""Declared schemas and their comparison with actual frames."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def schema_from_pairs(pairs: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n.lower(), TYPES[t.lower()]) for n, t in pairs.items()])


def schema_from_json(spark: SparkSession, path: str) -> T.StructType:
    """Schema from a JSON list of ``{"Name": ..., "Type": ...}``; names are
    lower-cased. The file is a few lines of metadata read through Spark, so any
    file system it can reach works."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    fields = json.loads(text)
    return schema_from_pairs({f["Name"]: f["Type"] for f in fields})


def check_contract(df: DataFrame, schema: T.StructType, ignore_case: bool = True) -> DataFrame:
    """Differences between declared and actual columns:
    ``column, declared, actual, problem`` (missing, undeclared or type)."""
    def fold(n: str) -> str:
        return n.lower() if ignore_case else n

    declared = {fold(f.name): f.dataType.simpleString() for f in schema.fields}
    actual = {fold(f.name): f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name in [*declared, *[n for n in actual if n not in declared]]:
        want, have = declared.get(name), actual.get(name)
        if want != have:
            rows.append((name, want, have, "missing" if have is None else "undeclared" if want is None else "type"))
    return df.sparkSession.createDataFrame(rows, "column string, declared string, actual string, problem string")


def missing_columns(df: DataFrame, required: Mapping[str, str]) -> list[str]:
    return [c for c in required if c not in df.columns]


#: Column that holds a line whose number of fields is not the declared one.
CORRUPT = "_corrupt_record"


def read_text_columns(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited text with every column as text, and the whole line in
    ``_corrupt_record`` where it has too few or too many fields."""
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField(CORRUPT, T.StringType())])
    options = {"header": header, "sep": sep, "nullValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.options(**options).schema(schema).csv(path)


def typed(text: Column, kind: T.DataType) -> Column:
    """A text as a value of the declared type, null where it is not one."""
    return F.trim(text).try_cast(kind)


def malformed_values(text: DataFrame, schema: T.StructType) -> DataFrame:
    """``column, declared, rows, blank, malformed, share, example`` of a frame
    of text columns held against a declared schema, from one aggregate.

    A value is malformed if it is not blank and does not parse as the declared
    type; ``share`` is of the values that are not blank, and ``example`` the
    least malformed one. A column that is not there is blank in every row.
    """
    fields = []
    for f in schema.fields:
        value = F.col(f.name).cast("string") if f.name in text.columns else F.lit(None).cast("string")
        blank = value.isNull() | (F.trim(value) == "")
        bad = ~blank & typed(value, f.dataType).isNull()
        filled = F.count(F.lit(1)) - F.count_if(blank)
        fields.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("declared"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(blank).alias("blank"),
                F.count_if(bad).alias("malformed"),
                F.coalesce(F.try_divide(F.count_if(bad), filled), F.lit(0.0)).alias("share"),
                F.min(F.when(bad, value)).alias("example"),
            )
        )
    if not fields:
        return text.sparkSession.createDataFrame([], "column string, declared string, rows long, blank long, malformed long, share double, example string")
    return text.agg(F.array(*fields).alias("_rows")).select(F.inline("_rows"))


def line_faults(text: DataFrame) -> DataFrame:
    """``rows, corrupt, empty``: lines read, those with a wrong number of fields,
    and those without any value."""
    values = [F.col(c) for c in text.columns if c != CORRUPT]
    empty = F.coalesce(*values).isNull()
    return text.agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(CORRUPT)).alias("corrupt"), F.count_if(empty).alias("empty"))


def apply_contract(text: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns with their types; text that does not parse, and a
    column that is not there, is null."""
    return text.select(
        *[(typed(F.col(f.name), f.dataType) if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    )
