"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Every query is run over its whole tables and written to Spark's ``noop`` sink, once
to warm up and then BENCH_RUNS times; the best time counts.

The text tables come as one file with one row group, which one task would read whole.
A copy of them in as many files as there are cores is made first, as large tables come
in many files; that is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "quality_report",
    "distributions",
    "text_quality",
    "completeness",
    "placeholder_metrics",
    "residual_scan",
    "heuristic_count",
    "detect_pii",
    "mask_text",
    "clean_provider_text",
    "payload_to_ticket",
    "guarded_tickets",
    "keyed_merge",
    "merge_counts",
    "parse_date_text",
    "pseudonyms",
    "feature_rows",
    "dry_run_report",
    "ingest_pages",
)


def spread(spark: SparkSession, sf_dir: str, files: int, to: str) -> str:
    """The same tables, the text tables in several files."""
    for name in sorted(os.listdir(sf_dir)):
        if name in ("documents.parquet", "pages.parquet", "conversations.parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(files).write.parquet(f"{to}/{name}")
        else:
            os.symlink(f"{sf_dir}/{name}", f"{to}/{name}")
    return to


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("guichet-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    holder = tempfile.TemporaryDirectory(prefix="guichet-bench-")
    tables = spread(spark, sf_dir, int(cpus), holder.name)
    for name in HEADLINE:
        best = float("inf")
        for attempt in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            if attempt:
                best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()
    holder.cleanup()


if __name__ == "__main__":
    main()
