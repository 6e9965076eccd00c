"""Compare single-pass operators with the per-column shapes they replace.

Prints a table of seconds at BENCH_SF_DIR; both sides read the same views and
run to completion.
"""

from __future__ import annotations

import os
import time
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators import cleaning, encoding, profiling
from creditloom.operators.entity import corr_with
from creditloom.plans import blocks, master, reports
from creditloom.plans.fixtures import view
from creditloom.session import local_session

CATEGORIES = ["code_gender", "name_contract_type", "name_education_type", "organization_type", "flag_own_car"]


def per_column_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    parts = [
        df.agg(
            F.lit(c).alias("variable"), F.count(c).alias("n"), F.min(c).cast("double").alias("min"),
            *[F.percentile_approx(F.col(c).cast("double"), q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)],
            F.avg(c).alias("mean"), F.max(c).cast("double").alias("max"),
        )
        for c in cols
    ]
    return reduce(DataFrame.unionByName, parts)


def windowed_last_status(previous: DataFrame) -> DataFrame:
    block = blocks.previous_features(previous).drop("prev_last_status")
    w = Window.partitionBy("sk_id_curr").orderBy(F.desc_nulls_last("days_decision"), F.desc("sk_id_prev"))
    last = previous.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("sk_id_curr", "name_contract_status")
    return block.join(last, "sk_id_curr", "left")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("creditloom-shapes")
    spark.sparkContext.setLogLevel("ERROR")
    app, bureau, previous = (view(spark, sf_dir, v) for v in ("fx_application", "fx_bureau", "fx_previous"))
    numeric = cleaning.numeric_columns(app, ["sk_id_curr", "target"])
    rules = reports.bureau_rules()

    def done(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    pairs = {
        "nulls in numeric columns": (
            lambda: [app.filter(F.col(c).isNull()).count() for c in numeric],
            lambda: done(profiling.quality_resume({"application": app})),
        ),
        "medians of numeric columns": (
            lambda: [app.approxQuantile(c, [0.5], 0.001) for c in numeric],
            lambda: cleaning.fit_median(app, numeric),
        ),
        "correlation with the label": (
            # stat.corr fails on a constant column
            lambda: [app.stat.corr(c, "target") for c in numeric if c != "flag_document_2"],
            lambda: done(corr_with(app, "target", numeric)),
        ),
        "numeric summary": (
            lambda: done(per_column_summary(app, numeric)),
            lambda: done(profiling.numeric_summary(app, numeric)),
        ),
        "business rules": (
            lambda: done(
                reduce(DataFrame.unionByName, [bureau.filter(c).withColumn("rule", F.lit(n)) for n, c in rules.items()])
                .groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("sk_id_curr").alias("k"))
            ),
            lambda: done(profiling.rule_violations(bureau, rules, "sk_id_curr")),
        ),
        "values of category columns": (
            lambda: [app.select(c).distinct().collect() for c in CATEGORIES],
            lambda: encoding.fit_values(app, CATEGORIES),
        ),
        "constant columns": (
            lambda: app.agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in app.columns]).first(),
            lambda: cleaning.constant_columns(app),
        ),
        "last status per client": (
            lambda: done(windowed_last_status(previous)),
            lambda: done(blocks.previous_features(previous)),
        ),
        "caps of amounts, counts and ratios": (
            lambda: [
                app.agg(F.percentile_approx(e, 0.995)).first()
                for e in [*(F.col(c) for c in master.AMOUNTS), *master.smoothed_ratios(app.columns).values()]
            ],
            lambda: encoding.fit_caps(
                app, {**{c: 0.995 for c in master.AMOUNTS}, **{n: (e, 0.995) for n, e in master.smoothed_ratios(app.columns).items()}}
            ),
        ),
    }
    print("| Work | per column / per branch | single pass |")
    print("|---|---|---|")
    for name, (slow, fast) in pairs.items():
        best = []
        for run in (slow, fast):
            seconds = []
            for _ in range(3):
                start = time.perf_counter()
                run()
                seconds.append(time.perf_counter() - start)
            best.append(min(seconds))
        print(f"| {name} | {best[0]:.2f} s | {best[1]:.2f} s |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
