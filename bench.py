"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores. Each query runs once
to warm up and three times for the median, into a sink that keeps nothing, so that whole results are
computed.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import aggregates, charts, cleaning, files_and_jobs  # noqa: E402, F401
from checks import statistics as statistics_checks  # noqa: E402, F401
from checks.registry import QUERIES  # noqa: E402

HEADLINE = [
    "sales_kpis", "sales_by_category", "sales_by_city", "top_products_by_revenue", "group_by_multi", "pivot_sum",
    "cross_tab", "trend_monthly", "cohort_analysis", "validate_sales", "remove_outliers_iqr", "impute_median",
    "impute_forward_fill", "scale_standard", "encode_labels", "describe_all", "percentiles", "correlation_pearson",
    "correlation_spearman", "correlation_kendall", "chi2_test", "chart_histogram", "chart_box",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({
        "metric": "sum of median warm query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "master": f"local[{cpus}]",
        "shuffle_partitions": int(cpus),
    }))


if __name__ == "__main__":
    main()
