"""Times the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs once to warm up, then BENCH_RUNS (default 3) times; the median counts. ``yardstick`` holds
the same results computed the obvious way (see checks/direct.py) and is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from checks.direct import direct_counts
from checks.queries import FULL, fused_report, registry
from checks.shapes import shapes
from tallygrid import period_change
from tallygrid.sources.tables import parquet_tables

HEADLINE = (
    "unified",
    "unified_full",
    "fused_shapes_full",
    "scaffold",
    "metric_grid",
    "incidents_full",
    "refresh_times",
    "period_change_events",
    "category_events_full",
    "cell_open_lines_full",
    "compound_orders_full",
    "two_rules_orders_full",
    "null_bucket_lines_full",
    "derived_detail_sum_lines_full",
    "derived_detail_cast_events_full",
    "unpivot_measures_lines_full",
    "unpivot_categories_lines_full",
    "sparse_orders_full",
)


def direct_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [s for s in shapes().values() if s.source != "events"]
    return period_change(direct_counts(spark, specs, *FULL, parquet_tables(spark, sf_dir)))


def seconds(query, runs: int) -> float:
    taken = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken[1:]), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Recording the call site of every column expression costs more than planning these queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entries = registry()
    names = [name for name in HEADLINE if name in (sys.argv[1:] or HEADLINE)]
    timed = {name: seconds(partial(entries[name][0], spark, sf_dir), runs) for name in names}
    yardstick = {
        "shapes_full_direct": seconds(partial(direct_report, spark, sf_dir), runs),
        "shapes_full_fused": seconds(partial(fused_report, spark, sf_dir), runs),
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 4),
                "unit": "sec",
                "queries": timed,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "yardstick": yardstick,
            }
        )
    )


if __name__ == "__main__":
    main()
