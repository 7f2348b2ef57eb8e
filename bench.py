"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from riskweft.queries import load_all
from riskweft.queries.registry import QUERIES
from riskweft.session import build_session, drop_staged

HEADLINE = [
    "fe7_all_groups", "ft5_temporal_set_t4", "eda2_summary", "eda6_descriptive_stats", "eda8_rate_by_category", "eda9_rate_by_bin", "spl1_stratified_split",
    "spl4_stratified_folds_k5", "smp2_oversample", "pp7_transform_all_splits", "met3_roc_auc", "met7_threshold_table", "met9_best_threshold",
    "mod12_segment_decisions", "mod13_weighted_ensemble", "dia1_error_contrast", "dia3_score_correlation", "dia4_duplicate_groups",
    "mon1_quality_by_day", "mon2_psi", "mon3_ks_distance", "mon5_realised_performance",
    "dia5_opposite_label_rate_2", "dia5_opposite_label_rate_pruned", "mod2_logistic_regression", "mod6_boosted_pos_weight", "mon7_stream_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    load_all()
    # One untimed query starts the executor threads and loads the Parquet reader.
    QUERIES["eda3_label_distribution"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        drop_staged(spark)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
