"""Headline timings as one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.  Each query is
built and run to the end into the no-op sink; the best of BENCH_RUNS counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from shelfstream.plans.report_registry import REPORTS
from shelfstream.workload import registered

HEADLINE = [
    "left_items_circs",
    "agg_circs_all",
    "lending_multi_left",
    "transactions_union",
    "transactions_alltime",
    "agg_holds_count",
    "agg_orders",
    "agg_hold_copy_ratio",
    "upsert_bibs",
    "bib_fields",
    "chq_item_rows",
    "chq_bib_rows",
    "sample_delta",
    "koha_agg_circs",
    "trace_related_lines",
    "agg_circs_incremental",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfstream-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = registered()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("agg_circs_all")  # JVM and file-cache warm-up, not counted
    seconds = {name: round(min(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    seconds["reports_57"] = round(sum(min(run(name) for _ in range(runs)) for name in REPORTS), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
