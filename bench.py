"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.catalog import QUERIES
from tessera.session import local_session

HEADLINE = [
    "agg_01_daily_sales_metrics",
    "agg_04_receipt_stats",
    "agg_15_price_summary",
    "agg_16_popularity",
    "agg_18_quantiles",
    "jn_04_left_join_on_week",
    "win_01_lag_block",
    "win_02_rolling_rows",
    "win_06_standardise",
    "win_10_rank_in_group",
    "ab_02_t_test",
    "ab_03_mann_whitney",
    "ab_04_bootstrap_mean_difference",
    "ab_12_stratified_selection",
    "ab_19_cuped_metric",
    "ab_30_method_comparison",
    "ab_35_benjamini_hochberg",
    "ab_38_slot_assignment",
    "ab_41_sequential_test",
    "ab_48_permutation_check",
    "fs_02_feature_table",
    "fs_06_leave_one_out",
    "up_03_split_gains",
    "up_10_uplift_at_k",
    "rk_01_swapped_pairs",
    "rk_04_ndcg",
    "rk_11_lambdas",
    "tx_01_vocabulary",
    "tx_05_text_vectors",
    "vs_01_exact_neighbours",
    "pr_07_seasonal_profile",
    "pr_11_price_model_features",
    "bd_05_cumulative_regret",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        if sys.argv[1:]:
            print(f"{times[name]:8.2f} {name}", file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))


if __name__ == "__main__":
    main()
