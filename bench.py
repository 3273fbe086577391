"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local cores.
Every query is run twice and the second, warm run is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from riskmill.plans import catalog  # noqa: E402

HEADLINE = (
    "scan_profile",
    "clean_report",
    "missing_profile",
    "scale_repair",
    "repair_stats",
    "repair_distribution",
    "range_check",
    "dedup_exact",
    "dedup_report",
    "dedup_texts",
    "features_s2",
    "histogram",
    "stratified_split",
    "stratified_folds",
    "threshold_table",
    "roc_points",
    "average_precision",
    "cv_summary",
    "select_candidate",
    "impute_scale",
    "onehot_rare",
    "prepare_table",
    "lr_balanced_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
