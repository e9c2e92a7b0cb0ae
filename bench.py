"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS set the data and the number of threads, BENCH_QUERIES a comma
separated choice of queries, BENCH_RUNS the number of timed runs (median). The session is warmed up
once; BENCH_WARM=1 also runs every query once before it is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seriesprep import catalog  # noqa: E402

HEADLINE = (
    "anomalous_hours_per_day", "read_table", "dedup_first", "coerce_numeric", "preprocess",
    "lag_features", "lag_features_long", "lag_features_by_series", "rolling_past_long", "zscore_flag_past_long",
    "rolling_time_by_series", "rolling_time_dense", "ewm_mean_long", "ffill_long", "interpolate_time_long",
    "row_index_long", "feature_store", "feature_store_full", "feature_store_long", "residual_flag", "split_by_ratio",
    "export_splits", "label_horizons", "baseline_persistence", "impute_median", "standard_scale",
    "classification_report", "rmse", "describe_all", "histogram", "correlation_matrix", "correlation_matrix_lines",
    "check_drift", "isolation_forest", "fit_tree_classifier", "fit_gbt_regressor", "fit_mlp_regression",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.queries()
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    warm = os.environ.get("BENCH_WARM") == "1"

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])
    times: dict[str, float] = {}
    for name in names:
        if warm:
            run(name)
        measured = [run(name) for _ in range(runs)]
        times[name] = round(statistics.median(measured), 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
