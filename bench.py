"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query is run to completion through the
``noop`` sink (no collect); one warm-up pass, then the median of the repeats.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    ("w13_features", "w13_features"),
    ("j1_terminals_in_radius", "j1_terminals_in_radius"),
    ("f6_fraud_label", "f6_fraud_label"),
    ("a5_daily_stats", "a5_daily_stats"),
    ("a6_hourly_batch", "a6_hourly_batch"),
    ("t6_dense_id", "t6_dense_id_in_time_order"),
    ("a10_correlation", "a10_correlation_matrix"),
]


def comparable_to_baseline(spark, sf_dir: str) -> dict:
    """
    (records/s through parse -> model -> Parquet sink) and the wall time of
    a random-forest 5-fold CV fit (numTrees 5/10/15/20, hard labels): ROC
    alone with MLlib's CrossValidator, and ROC + PR in one shared pass."""
    from pyspark.ml import Pipeline

    from txpipe.operators import model as M
    from txpipe.operators.features import build_features
    from txpipe.plans.common import labelled
    from txpipe.plans.q_stream import write_inputs
    from txpipe.session import stored, work_path
    from txpipe.streaming import scoring as SC

    feats = stored(build_features(labelled(spark, sf_dir)), "bench-features")
    n = feats.count()
    idx = M.label_indexer(feats)
    model = Pipeline(stages=M.pipeline("random_forest", idx).getStages()).fit(feats)
    base = work_path(spark, "bench-stream")
    write_inputs(feats, f"{base}/in")
    t0 = time.perf_counter()
    q = SC.start_scoring(spark, model, f"{base}/sink", f"{base}/ckpt", "text", f"{base}/in", {"maxFilesPerTrigger": "1"})
    SC.await_all([q], 1800)
    stream_s = time.perf_counter() - t0
    t0 = time.perf_counter()
    prepared = M.prepare(feats, idx)
    M.tune("random_forest", prepared, idx, metric="areaUnderROC")
    cv_s = time.perf_counter() - t0
    t0 = time.perf_counter()
    M.tune_both("random_forest", prepared, idx)
    cv_both_s = time.perf_counter() - t0
    return {
        "stream_records": n,
        "stream_records_per_sec": round(n / stream_s, 1),
        "cv_random_forest_roc_sec": round(cv_s, 2),
        "cv_random_forest_roc_and_pr_sec": round(cv_both_s, 2),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from txpipe.session import local_session
    from txpipe.plans.registry import queries

    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    qs = queries()

    def run(key: str) -> float:
        spark.catalog.clearCache()  # no run leans on another's leftovers
        t0 = time.perf_counter()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for _, key in HEADLINE:
        run(key)
    times = {}
    for name, key in HEADLINE:
        times[name] = round(statistics.median(run(key) for _ in range(repeat)), 3)
    extra = {}
    if os.environ.get("BENCH_EXTRA", "1") == "1":
        extra = comparable_to_baseline(spark, sf_dir)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "repeat": repeat,
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
