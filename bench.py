"""Benchmark: prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8);
``BENCH_QUERIES`` names other queries, or ``all``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from quarrymill.catalog import renditions
from quarrymill.session import local_session

HEADLINE = [
    "scan_csv_folder", "scan_text_records", "parse_rule_lines", "scan_html_table",
    "derive_row_total", "filter_complete_cases", "parameterised_view",
    "join_inner", "join_group_max_back", "join_last_state", "join_pair_sum", "join_triple_sum",
    "join_band", "join_window_pairs", "join_anti_gap", "join_semi",
    "agg_share_of_total", "agg_pivot_counts", "agg_distinct_per_column", "agg_set_intersection",
    "agg_missing_per_column", "agg_diff_histogram", "agg_density", "agg_conditional_count",
    "win_running_ratio", "win_running_sum_null_as_zero", "win_row_number", "win_run_length",
    "win_contiguous_sum", "win_rolling_lookback", "top_current_ratio",
    "topn_with_ties", "sample_n", "melt_wide_to_long", "set_except", "explode_members",
    "fn_record_valid", "fn_strided_grid_lookup", "fn_holiday_flags",
    "prep_impute_median", "prep_standardize", "prep_one_hot", "clean_chain",
    "split_stratified_kfold", "perm_test_runs", "graph_ancestors", "graph_weighted_descendants",
    "fit_knn", "metric_precision_recall_f1", "metric_roc_auc",
]


def run(spark, fn, folder: str) -> float:
    start = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    catalog = renditions()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog) if asked == "all" else asked.split(",") if asked else HEADLINE
    run(spark, catalog["agg_share_of_total"], folder)  # start-up of the engine
    times = {}
    for name in names:
        try:
            times[name] = round(run(spark, catalog[name], folder), 3)
        except Exception as e:  # one failing query must not hide the others
            print(f"{name} failed: {str(e)[:300]}", file=sys.stderr)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
