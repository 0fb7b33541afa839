"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINES = (
    "detect_intrusions",
    "parse_flows",
    "score_linear",
    "score_onnx",
    "page_view_counts",
    "hash_fields",
    "rate_simple",
    "rate_extrapolated",
    "instant_lookup",
    "hold",
    "alert_stream",
    "declared_rules",
    "latency_histogram",
    "latency_percentiles",
    "score_sessions",
    "stratified_split",
    "fit_scaler",
    "class_metrics",
    "stream_page_views",
)


#: Flow records of the throughput run; the table's are repeated up to so many.
FLOWS = 200_000


def flows_per_second(spark, sf_dir: str) -> float:
    """JSON flow records to alerts, warm."""
    from pyspark.sql import functions as F

    from flowspark.catalog.flows import scorer
    from flowspark.catalog.views import flow_records
    from flowspark.plans.intrusions import detect_intrusions
    from flowspark.session import tune, work_dir

    tune(spark)
    records, path = flow_records(spark, sf_dir), work_dir(spark, "bench-flows")
    copies = -(-FLOWS // records.count())
    records.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select("value").repartition(32).write.parquet(path)
    raw, took = spark.read.schema("value string").parquet(path), []
    n = raw.count()
    for _ in range(2):
        begin = time.perf_counter()
        detect_intrusions(raw, scorer).alerts.write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - begin)
    return n / min(took)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flowspark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from flowspark.catalog import QUERIES

    times: dict[str, float] = {}
    for name in HEADLINES:
        best = None
        for _ in range(2):  # the first run also compiles the plan
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {best:.2f}s", file=sys.stderr, flush=True)
    rate = flows_per_second(spark, sf_dir)
    print(f"{rate:.0f} flows/s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, better of two runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "flows_per_second": round(rate),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
