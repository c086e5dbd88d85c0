"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables (default sf0.1). BENCH_CPUS: cores (default all). BENCH_ALL=1: every query.
Each query runs once cold and BENCH_WARM times (default 3) warm into the ``noop`` sink; the value is the median warm time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from cohortloom.queries import QUERIES
from cohortloom.session import local_session

HEADLINE = [
    "pipe_cohort_outcomes", "pipe_choose_images", "pipe_prepare_predictions", "pipe_select_series", "pipe_locate_scans",
    "pipe_link_reports", "pipe_quality_tables", "pipe_inclusion_lists",
    "change_from_baseline", "outcome_label", "filter_time_window", "best_of_group", "argmin_per_group",
    "first_non_null_per_group", "override_selection", "prefer_variant", "waterfall_match", "join_path_prefix",
    "join_outer_indicator", "join_inner_multi_key", "join_anti", "pivot_tags", "melt", "histogram",
    "five_number_summary", "distinct_counts", "attrition_funnel", "dense_rank_per_subject", "global_row_id",
    "exact_split", "filter_exclude_words", "normalize_accession",
]


def run(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "*"))
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    warm_runs = int(os.environ.get("BENCH_WARM", "3"))
    cold, warm = {}, {}
    for name in names:
        cold[name] = run(name, spark, folder)
        warm[name] = statistics.median(run(name, spark, folder) for _ in range(warm_runs))
        print(f"{name} cold {cold[name]:.2f} warm {warm[name]:.2f}", file=sys.stderr)
    result = {
        "metric": "total warm time of the headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {n: round(s, 3) for n, s in warm.items()},
        "cold": {n: round(s, 3) for n, s in cold.items()},
        "sf": float(folder.rstrip("/").rsplit("sf", 1)[-1]),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
