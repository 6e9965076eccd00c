"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_QUERIES (names).
Each query runs to completion into a no-op sink, BENCH_RUNS times (3), and its best time counts. The first pass over
all queries also warms the JIT. Every run trains its model anew.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from creditloom.plans import forest
from creditloom.plans.queries import QUERIES
from creditloom.session import local_session

HEADLINE = [
    "entity_block_bureau", "entity_block_balance", "entity_block_previous_last",
    "entity_block_previous_numeric", "entity_block_installments", "entity_block_behaviour", "entity_block_pos",
    "entity_block_card", "category_shares", "application_features", "null_profile", "numeric_summary", "amount_summary",
    "iqr_outliers", "category_rate", "rule_violations", "corr_ranking", "exact_quantiles_global", "month_trend",
    "last_status_by_label", "bureau_label_summary", "severity_rate", "coverage_by_label", "stratified_split",
    "encode_mixed", "analytic_master", "client_master", "model_features", "exact_client_medians", "label_index_table",
    "quick_profile", "rank_features_p_values", "ml_ready", "forest_metrics", "client_master_bucketed", "grouped_auc",
    "sketch_behaviour_medians", "split_shares", "contract_malformed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session("creditloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times: dict[str, float] = {}
    for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
        for name in names.split(",") if names else HEADLINE:
            forest.forget()  # a stored model would leave only the reading to time
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = min(times.get(name, float("inf")), round(time.perf_counter() - start, 3))
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
