"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``.
Each query runs whole into a sink that discards rows; the figure is the median of
``BENCH_RUNS`` (default 3) runs after one warm-up. ``BENCH_QUERIES`` picks
queries by name, ``all`` takes every one.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from grainfold.plans import QUERIES
from grainfold.session import local_session

HEADLINE = [
    # rows
    "derive_cols", "guarded_ratio", "date_features", "json_segments", "clean_tokens", "dedupe", "one_hot", "category_codes",
    # joins and aggregates
    "join_chain", "dim_lookup", "canonical_code", "agent_willingness", "peer_deviation", "profile_by_factor",
    "class_price_stats", "describe", "corr_matrix", "distinct_profile", "tag_profile", "tag_similarity", "recommend",
    # ordered rows
    "impute_group_mean", "impute_group_mode", "group_size", "first_diff", "interpolate_linear", "gap_sessions",
    "merge_intervals", "interval_overlap_label", "bounded_jump_score",
    # series and signals
    "resample_gapfill", "acf", "periodogram", "stft_power", "cwt_ricker", "kde_grid",
    # text
    "bow_counts", "tfidf_terms", "vocab_filter", "token_index", "stopword_filter",
    # evaluation
    "classification_report", "regression_report", "roc_auc",
    # models
    "svm_binary", "rf_regress", "kmeans_sweep",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if picked == "all" else picked.split(",") if picked else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "grainfold-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 4)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum of median query seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
