"""Times the named queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from pulselog.plans import QUERIES

HEADLINE = (
    "word_count",
    "word_count_top",
    "event_log_counts",
    "stage_metrics",
    "jobs_ended",
    "tasks_ended",
    "task_metrics",
    "stage_rollup",
    "records_basic",
    "records_extended",
    "prometheus_samples",
    "exposition_text",
    "exposition_text_extended",
    "push_requests",
    "kafka_rows",
    "latest_samples",
    "scrape_samples",
    "sanitize_metric_name",
    "latest_samples_stream",
    "scrape_samples_stream",
    "event_files_rollup",
    "event_stream_records",
    "value_intervals",
)


TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


def spread(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The tables as folders of several files, as large tables lie; written before the clock."""
    root = tempfile.mkdtemp(prefix="pulselog-bench-")
    for name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(files).write.parquet(f"{root}/{name}.parquet")
    return root


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pulselog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = spread(spark, sf_dir, int(cpus))
    # Starts executor threads and loads classes; not timed.
    QUERIES["executor_added"](spark, tables).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
