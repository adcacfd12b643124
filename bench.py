"""Benchmark the headline operators and the end-to-end job; one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Setup (not timed): the ``tx`` fixture is materialised once, as Parquet and
as multi-file delimited text, the way a real input sits on storage. Each
query then runs to completion through the ``noop`` sink (full execution,
nothing collected), by the default method, the one that the oracles check. One
untimed warm-up pass precedes three timed passes; each query reports its median.

With BENCH_COPIES=n (default 0: not run) ``prepare`` also runs once over n copies of
the fixture with ids of their own, so that rows outweigh Spark's fixed cost.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .appName("txprep-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from txprep import fixtures
    from txprep.operators import (class_distribution, clean, dedup, null_profile, numeric_stats,
                                  outlier_bounds, quantiles, report_metrics, resolve_bounds,
                                  rule_failures, validate, waterfall)
    from txprep.plans import analyze, ml_ready, prepare
    from txprep.scratch import scratch_path
    from txprep.sources import inventory, read_delimited

    tx_pq, tx_csv = scratch_path(spark, "bench-tx-parquet"), scratch_path(spark, "bench-tx-csv")
    fixture = fixtures.tx(spark, sf_dir).repartition(cpus)
    fixture.write.parquet(tx_pq)
    fixture.write.option("header", True).csv(tx_csv)
    tx = spark.read.parquet(tx_pq)
    lineitem = fixtures.table(spark, sf_dir, "lineitem")
    orders = fixtures.table(spark, sf_dir, "orders")

    def waterfall_exact():
        return waterfall(tx, resolve_bounds(outlier_bounds(validate(tx), method="exact")))

    queries = {
        "validate": lambda: validate(tx),
        "rule_failures": lambda: rule_failures(tx),
        "null_profile": lambda: null_profile(tx),
        "outlier_bounds_sketch": lambda: outlier_bounds(validate(tx), method="sketch"),
        "outlier_bounds_exact": lambda: outlier_bounds(validate(tx), method="exact"),
        "clean": lambda: clean(tx),
        "clean_waterfall": waterfall_exact,
        "ml_ready": lambda: ml_ready(tx),
        "class_distribution": lambda: class_distribution(ml_ready(tx)),
        "dedup_lineitem": lambda: dedup(lineitem, "l_orderkey"),
        "quantiles_exact_lineitem": lambda: quantiles(
            lineitem, "l_extendedprice", {"p1": 0.01, "q1": 0.25, "q3": 0.75, "p99": 0.99}, method="exact"),
        "numeric_stats_lineitem": lambda: numeric_stats(lineitem),
        "report_metrics_orders": lambda: report_metrics(orders, label="o_orderstatus"),
        "csv_scan_validate": lambda: validate(read_delimited(spark, tx_csv)),
        "inventory": lambda: inventory(spark, sf_dir),
        "analyze_inventory": lambda: analyze(spark, sf_dir),
    }

    sc = spark.sparkContext
    jobs: dict[str, int] = {}

    def grouped(name: str, fn):
        # a job group per query: the status tracker then counts its Spark jobs
        # (with AQE each materialised shuffle stage is a job of its own)
        group = f"bench-{name}-{time.perf_counter_ns()}"
        sc.setJobGroup(group, name)
        try:
            return fn()
        finally:
            jobs[name] = len(sc.statusTracker().getJobIdsForGroup(group))
            sc.setJobGroup("", "")

    def run(make, name=None) -> float:
        t0 = time.perf_counter()
        action = lambda: make().write.format("noop").mode("overwrite").save()
        grouped(name, action) if name else action()
        return time.perf_counter() - t0

    def run_prepare() -> tuple[float, object]:
        t0 = time.perf_counter()
        res = grouped("prepare", lambda: prepare(spark, tx_csv, scratch_path(spark, "bench-ml-ready")))
        return time.perf_counter() - t0, res

    for make in queries.values():      # warm-up
        run(make)
    run_prepare()

    times = {name: round(median(run(make, name) for _ in range(3)), 3) for name, make in queries.items()}
    runs = [run_prepare() for _ in range(3)]
    t, res = sorted(runs, key=lambda r: r[0])[1]
    times["prepare"] = round(t, 3)

    large = {}
    copies = int(os.environ.get("BENCH_COPIES", "0"))
    if copies:
        from pyspark.sql import functions as F
        big = scratch_path(spark, "bench-large")
        shifted = F.col("transaction_id") + F.col("copy") * 1_000_000_000
        # one copy a row of this small range
        tx.join(F.broadcast(spark.range(copies).withColumnRenamed("id", "copy")), F.col("copy") >= 0) \
            .withColumn("transaction_id", shifted).drop("copy").write.option("header", True).csv(big)
        t0 = time.perf_counter()
        done = prepare(spark, big, scratch_path(spark, "bench-large-out"))
        t = time.perf_counter() - t0
        large = {"large_prepare_rows": done.input_rows, "large_prepare_sec": round(t, 1),
                 "large_prepare_rows_per_sec": round(done.input_rows / t)}

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else None,
        "spark_jobs": jobs,
        "prepare_input_rows": res.input_rows,
        "prepare_rows_per_sec": round(res.input_rows / times["prepare"], 1), **large,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
