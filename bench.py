"""Headline timings, as one line of JSON.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. The feed
is landed once; then ingestion and the clean step are timed from the landed
documents, and every question from the table. Each figure is the median of
``BENCH_RUNS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tremorline import Run, ingest, read_table
from tremorline import operators as ops
from tremorline.plans.analysis import QUESTIONS
from tremorline.schema import nested_event_schema
from tremorline.sources import append_table, latest_day, read_cells, read_landing, write_landing
from tremorline.sources.derived_feed import feed_rows, to_documents, to_features
from tremorline.sources.paths import scratch_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(work: Callable[[], object]) -> float:
    seconds = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tremorline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    root = scratch_dir(spark, "bench")
    landed = Run(root)
    documents = to_documents(to_features(feed_rows(spark, SF_DIR)))
    write_landing(documents, landed.landing)

    def whole_run() -> None:
        run = Run(scratch_dir(spark, "bench-run"), landed.at)
        ingest(spark, run, f"{run.root}/table", lines=spark.read.text(landed.landing))

    def clean_only() -> None:
        events = ops.clean(ops.explode_features(read_landing(spark, landed.landing)))
        events.write.format("noop").mode("overwrite").save()

    # One line in fifty more that is no document.
    spoilt = f"{root}/spoilt"
    failed = spark.range(max(1, documents.count() // 50)).select(F.lit("None").alias("value"))
    write_landing(documents.union(failed.coalesce(1)), spoilt)

    def run_with_rejects() -> None:
        run = Run(scratch_dir(spark, "bench-run"), landed.at)
        ingest(spark, run, f"{run.root}/table", lines=spark.read.text(spoilt))

    # The clean step first: it warms the compiler up for the whole run.
    figures = {
        "clean": timed(clean_only),
        "ingest": timed(whole_run),
        "ingest_with_rejects": timed(run_with_rejects),
    }

    ingest(spark, landed, f"{root}/table")
    table = read_table(spark, f"{root}/table", nested_event_schema())
    append_table(table, f"{root}/by-day", nested_event_schema(), by_day=True)
    by_day = read_table(spark, f"{root}/by-day", nested_event_schema())
    for name, question in QUESTIONS.items():
        figures[name] = timed(lambda: question(table).collect())
    figures["mags_by_region"] = timed(
        lambda: ops.magnitudes_by_region(table).write.format("noop").mode("overwrite").save()
    )
    figures["count_by_day_partitioned"] = timed(lambda: QUESTIONS["count_by_day"](by_day).collect())
    figures["strongest_region_last_week_partitioned"] = timed(
        lambda: ops.strongest_regions(by_day, last_day=latest_day(spark, f"{root}/by-day")).collect()
    )
    cells = read_cells(spark, f"{root}/table")
    figures["count_by_day_from_cells"] = timed(lambda: ops.count_by_day(cells).collect())

    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(figures.values()), 3),
                "unit": "sec",
                "queries": figures,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "rows": table.count(),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
