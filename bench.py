"""Time the headline queries and print one JSON line.

Long queries come last, a query that fails is named under ``failed``, and a run that is stopped (SIGTERM) still
prints what it has measured.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose the data and the cores;
BENCH_ONLY (comma separated) restricts the queries.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holdfast.plans import catalog  # noqa: E402
from holdfast.session import local_session  # noqa: E402

HEADLINE = [
    "ingest_merge",
    "latest_nonnull_per_key",
    "column_profile",
    "anomaly_rollup",
    "pii_findings",
    "pii_redact_text",
    "harmonize_cast_fill",
    "clean_frame",
    "guarded_ratios",
    "feature_export",
    "running_average",
    "drift_report",
    "ks_statistic",
    "target_correlation",
    "spearman_correlation",
    "correlation_matrix",
    "vif",
    "class_metrics",
    "roc_auc",
    "fallback_chain",
    "request_validation",
    "window_mean",
    "window_p99",
    "sustained_alert",
    "batch_score",
    "smote",
    "student_reduced_frame",
    "adaboost",
    "smoteenn",
    "permutation_importance",
    "stream_drift_check",
    "stream_window_mean",
    "stream_cache_lookup",
    "train_compete",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"), name="holdfast-bench")
    # start the JVM and the Python workers before the clock
    spark.range(1000).selectExpr("sum(id)").collect()
    spark.range(8).mapInPandas(lambda it: it, "id long").count()
    seconds, failed = {}, {}

    def report(stopped: str | None = None) -> None:
        told = {
            "metric": "headline_total_seconds",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            "cpus": cpus,
        }
        if failed or stopped:
            told |= {"failed": failed, "stopped_in": stopped}
        print(json.dumps(told), flush=True)

    running = None

    def stop(*_) -> None:
        report(running)
        os._exit(0)

    signal.signal(signal.SIGTERM, stop)
    for running in only or HEADLINE:
        start = time.perf_counter()
        try:
            catalog.QUERIES[running](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as problem:  # the others are still worth their figures
            failed[running] = str(problem)[:200]
            continue
        seconds[running] = round(time.perf_counter() - start, 3)
        print(f"{running}: {seconds[running]}", file=sys.stderr, flush=True)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
