"""Data-quality profiles and distribution tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.naming import business_role
from creditloom.functions.quantiles import SKETCH_ACCURACY, distinct_estimate, exact_quantiles, q_approx, quantile_columns
from creditloom.operators.cleaning import numeric_columns
from creditloom.operators.entity import Metric, global_aggregate
from creditloom.operators.shaping import share_of_total, stack_reports, to_long, top_k


def per_column(df: DataFrame, cols: Sequence[str], fields) -> DataFrame:
    """One row per column out of one aggregate over one scan.

    ``fields(name)`` returns the aggregate fields of a column; the wide row is
    turned into a table afterwards, so the data itself is never multiplied.
    """
    rows = [F.struct(F.lit(c).alias("variable"), *[e.alias(n) for n, e in fields(c).items()]) for c in cols]
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def null_profile(df: DataFrame, n: int | None = None, digits: int | None = 4) -> DataFrame:
    """Nulls, rows and null percentage per column, worst first."""

    def fields(c: str) -> dict[str, Column]:
        nulls, total = F.count_if(F.col(c).isNull()), F.count(F.lit(1))
        pct = F.try_divide(nulls * F.lit(100.0), total)
        return {"nulls": nulls, "total": total, "pct_nulls": F.round(pct, digits) if digits is not None else pct}

    out = per_column(df, df.columns, fields).withColumnRenamed("variable", "column")
    ordered = out.orderBy(F.desc("pct_nulls"), F.desc("nulls"), "column")
    return ordered.limit(n) if n is not None else ordered


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stack_reports(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    )


def schema_inventory(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table string, column string, type string").orderBy("table", "column")


def numeric_summary(
    df: DataFrame,
    cols: Sequence[str],
    quantiles: Mapping[str, float] | None = None,
    method: str = "approx",
    accuracy: int = SKETCH_ACCURACY,
    digits: int | None = None,
) -> DataFrame:
    """Count, nulls, min, mean, max and quantiles per column.

    ``method="exact"`` replaces the sketches by exact ranks.
    """
    names = dict(quantiles or {"p25": 0.25, "median": 0.5, "p75": 0.75})

    def rounded(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    def fields(c: str) -> dict[str, Column]:
        v = F.col(c).cast("double")
        out = {
            "n": F.count(v),
            "nulls": F.count_if(v.isNull()),
            "min": rounded(F.min(v)),
            "mean": rounded(F.avg(v)),
            "max": rounded(F.max(v)),
        }
        if method == "approx":
            # the same sketch for all probabilities: Spark computes it once
            sketch = q_approx(v, list(names.values()), accuracy)
            out |= {name: rounded(F.get(sketch, F.lit(i))) for i, name in enumerate(names)}
        return out

    base = per_column(df, cols, fields)
    if method == "approx":
        return base
    exact = quantile_columns(
        exact_quantiles(df, cols, sorted(set(names.values()))), {q: name for name, q in names.items()}
    )
    joined = base.join(exact, "variable", "left")
    return joined.withColumns({name: rounded(F.col(name)) for name in names})


@dataclass(frozen=True)
class IqrBounds:
    q1: float
    q3: float
    k: float

    @property
    def lower(self) -> float:
        return self.q1 - self.k * (self.q3 - self.q1)

    @property
    def upper(self) -> float:
        return self.q3 + self.k * (self.q3 - self.q1)


def fit_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "approx",
            accuracy: int = SKETCH_ACCURACY) -> dict[str, IqrBounds]:
    if method == "exact":
        found: dict[str, dict[float, float]] = {}
        for r in exact_quantiles(df, cols, [0.25, 0.75]).collect():
            found.setdefault(r["variable"], {})[r["q"]] = r["value"]
        return {c: IqrBounds(v[0.25], v[0.75], k) for c, v in found.items()}
    row = df.agg(
        *[q_approx(F.col(c).cast("double"), [0.25, 0.75], accuracy).alias(f"q{i}") for i, c in enumerate(cols)]
    ).first()
    return {c: IqrBounds(*row[f"q{i}"], k) for i, c in enumerate(cols) if row[f"q{i}"]}


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "approx",
                 digits: int | None = None) -> DataFrame:
    """Rows outside the quartile fences per column, nulls left out. Two passes
    for all columns together: quartiles, then one conditional count."""
    bounds = fit_iqr(df, cols, k, method)

    def fields(c: str) -> dict[str, Column]:
        b, v = bounds[c], F.col(c).cast("double")
        outliers = F.count_if((v < F.lit(b.lower)) | (v > F.lit(b.upper)))
        pct = F.try_divide(outliers * F.lit(100.0), F.count(v))
        return {
            "q1": F.lit(b.q1),
            "q3": F.lit(b.q3),
            "iqr": F.lit(b.q3 - b.q1),
            "lower_bound": F.lit(b.lower),
            "upper_bound": F.lit(b.upper),
            "outliers": outliers,
            "total": F.count(v),
            "pct_outliers": F.round(pct, digits) if digits is not None else pct,
        }

    return per_column(df, [c for c in cols if c in bounds], fields)


def category_rate(
    df: DataFrame, cols: Sequence[str], label: str = "target", domain: Sequence[int] = (0, 1), digits: int | None = None
) -> DataFrame:
    """Rows, positives and positive percentage of every value of every listed
    column. All columns are unpivoted from the same scan; the values combine
    before the shuffle."""
    long = to_long(df.filter(F.col(label).isin(list(domain))), cols, [label], "string")
    rate = F.count_if(F.col(label) == 1) * F.lit(100.0) / F.count(F.lit(1))
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(label) == 1).alias("defaults"),
            (F.round(rate, digits) if digits is not None else rate).alias("default_rate_pct"),
        )
    )


def rule_violations(df: DataFrame, rules: Mapping[str, Column], entity: str, digits: int | None = None) -> DataFrame:
    """Rows and entities breaking each rule, with the share of all rows.

    Each row is read once and yields the names of the rules it breaks.
    """
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    total = df.agg(F.count(F.lit(1))).scalar()
    hits = df.select(entity, F.explode(broken).alias("rule")).groupBy("rule").agg(
        F.count(F.lit(1)).alias("rows_affected"), F.count_distinct(entity).alias("entities_affected")
    )
    pct = F.col("rows_affected") * F.lit(100.0) / total
    return hits.withColumn("pct_of_rows", F.round(pct, digits) if digits is not None else pct)


def quality_resume(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and nulls in numeric columns per table, one scan each."""
    reports = []
    for name, df in tables.items():
        nulls = F.lit(0).cast("bigint")
        for c in numeric_columns(df):
            nulls = nulls + F.count_if(F.col(c).isNull())
        reports.append(
            df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("numeric_nulls")).select(
                F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"), "numeric_nulls"
            )
        )
    return stack_reports(reports)


def validate_master(
    master: DataFrame, base: DataFrame, key: str, features: Sequence[str] = (), label: str = "target"
) -> DataFrame:
    """Checks of an assembled master as ``check_group, check_name, check_value``.

    Row counts, distinct and duplicated keys and null counts come from one
    aggregation by key, so no global distinct set is built.
    """
    watched = [c for c in [label, *features] if c in master.columns]
    per_key = master.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(watched)]
    )
    base_rows = base.agg(F.count(F.lit(1))).scalar()
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    types = [f.dataType for f in master.schema.fields if f.name not in (key, label)]
    checks = [
        ("rows", "rows_master", rows),
        ("keys", "distinct_keys", F.count_if(F.col(key).isNotNull())),
        ("keys", "duplicated_keys", F.count_if(F.col("_n") > 1)),
        *[("nulls", f"nulls_{c}", F.coalesce(F.sum(f"_z{i}"), F.lit(0))) for i, c in enumerate(watched)],
        ("schema", "categorical_columns", F.lit(sum(isinstance(t, T.StringType) for t in types))),
        ("schema", "numeric_columns", F.lit(sum(isinstance(t, T.NumericType) for t in types))),
    ]
    one = per_key.agg(*[c.cast("double").alias(f"v{i}") for i, (_, _, c) in enumerate(checks)])
    one = one.withColumn("base", base_rows.cast("double"))
    table = [
        F.struct(F.lit(g).alias("check_group"), F.lit(n).alias("check_name"), F.col(f"v{i}").alias("check_value"))
        for i, (g, n, _) in enumerate(checks)
    ]
    table.append(
        F.struct(
            F.lit("rows").alias("check_group"),
            F.lit("rows_master_eq_base").alias("check_name"),
            (F.col("v0") == F.col("base")).cast("double").alias("check_value"),
        )
    )
    return one.select(F.inline(F.array(*table)))


def label_distribution(
    df: DataFrame, label: str = "target", domain: Sequence[int] | None = (0, 1), digits: int | None = None
) -> DataFrame:
    rows = df.filter(F.col(label).isin(list(domain))) if domain is not None else df
    return share_of_total(rows, label, digits=digits)


def quick_profile(df: DataFrame, exact: bool = False, digits: int | None = 2) -> DataFrame:
    """Type, nulls, distinct values, null percentage and business role of every
    column. Distinct counts are sketches by default; ``exact=True`` counts them
    over the unpivoted values, deduplicated before the shuffle."""
    types = dict(df.dtypes)

    def fields(c: str) -> dict[str, Column]:
        nulls = F.count_if(F.col(c).isNull())
        pct = F.try_divide(nulls * F.lit(100.0), F.count(F.lit(1)))
        out = {"type": F.lit(types[c]), "nulls": nulls}
        if not exact:
            out["distinct_values"] = distinct_estimate(c)
        return out | {
            "pct_nulls": F.round(pct, digits) if digits is not None else pct,
            "role": F.lit(business_role(c)),
        }

    base = per_column(df, df.columns, fields)
    if exact:
        values = to_long(df, df.columns, as_type="string").filter(F.col("value").isNotNull()).distinct()
        counts = values.groupBy("variable").agg(F.count(F.lit(1)).alias("distinct_values"))
        base = base.join(counts, "variable", "left").withColumn(
            "distinct_values", F.coalesce("distinct_values", F.lit(0))
        )
    order = ["column", "type", "nulls", "distinct_values", "pct_nulls", "role"]
    profile = base.withColumnRenamed("variable", "column").select(*order)
    return profile.orderBy(F.desc("pct_nulls"), F.desc("distinct_values"), "column")


def top_missing(profile: DataFrame, n: int = 10) -> DataFrame:
    return top_k(profile.filter(F.col("pct_nulls") > 0), "pct_nulls", n, "column")


# The first of these columns that exists gives the amount KPI.
KPI_AMOUNTS = ("amt_income_total_cap", "amt_income_total", "amt_credit_cap", "amt_credit", "amt_annuity")


def business_kpis(df: DataFrame, label: str = "target") -> DataFrame:
    """One row: rows, columns, positive rate, first available mean amount, mean
    external score and mean late share. The first amount column with any value
    wins, decided inside the same aggregate."""
    amounts = [c for c in KPI_AMOUNTS if c in df.columns]
    metrics: list[Column] = [F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns")]
    if label in df.columns:
        metrics.append((F.avg(F.col(label).cast("double")) * F.lit(100.0)).alias("positive_rate_pct"))
    if amounts:
        means = [F.avg(F.col(c).cast("double")) for c in amounts]
        chain = None
        for c, m in zip(amounts, means):
            chain = F.when(m.isNotNull(), F.lit(c)) if chain is None else chain.when(m.isNotNull(), F.lit(c))
        metrics += [F.coalesce(*means).alias("mean_amount"), chain.alias("amount_column")]
    if "ext_sources_mean" in df.columns:
        metrics.append(F.avg("ext_sources_mean").alias("mean_external_score"))
    if "late_payment_mean" in df.columns:
        metrics.append((F.avg("late_payment_mean") * F.lit(100.0)).alias("mean_late_share_pct"))
    return df.agg(*metrics)


def distribution_summary(
    df: DataFrame, cols: Sequence[str], by: str | None = None, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Box-plot numbers (count, min, quartiles, max, mean) per column and,
    optionally, per group."""
    keys = [by] if by else []
    long = to_long(df, cols, keys, "double").filter(F.col("value").isNotNull())
    stats = long.groupBy(*keys, "variable").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("min"),
        q_approx("value", [0.25, 0.5, 0.75], accuracy).alias("_q"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
    )
    picks = [F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(("p25", "median", "p75"))]
    return stats.select(*keys, "variable", "n", "min", *picks, "max", "mean")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of all rows: ``bin, lower, upper, n``; empty bins
    are kept, the maximum falls into the last one and NaN into a bin of null
    number, which is there only if there are some."""
    number = F.col(column).cast("double")
    v = F.when(~F.isnan(number), number)
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return edges.select("bin", *[F.lit(None).cast("double").alias(n) for n in ("lower", "upper")], F.lit(0).cast("bigint").alias("n"))
    width = (hi - lo) / bins or 1.0
    slot = F.least(F.floor((v - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    counts = df.filter(v.isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    missing = [F.lit(None).cast("double").alias(n) for n in ("lower", "upper")]
    nans = df.agg(F.count_if(F.isnan(number)).alias("n")).filter("n > 0").select(F.lit(None).cast("int").alias("bin"), *missing, "n")
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ).unionByName(nans)


def overview(df: DataFrame, distinct: Mapping[str, str], ranges: Mapping[str, str] | None = None,
             ratios: Mapping[str, str] | None = None) -> DataFrame:
    """Rows, distinct counts, value ranges and rows per distinct key in one
    row. Each distinct count is taken over values deduplicated before the
    shuffle."""
    metrics = [Metric("rows", "count")]
    metrics += [Metric(name, "count_distinct", c) for name, c in distinct.items()]
    for name, c in (ranges or {}).items():
        metrics += [Metric(f"{name}_min", "min", c), Metric(f"{name}_max", "max", c)]
    out = global_aggregate(df, metrics)
    return out.withColumns(
        {name: F.try_divide(F.col("rows").cast("double"), F.col(base)) for name, base in (ratios or {}).items()}
    )
