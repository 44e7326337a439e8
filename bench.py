"""Time the view queries and print one JSON line.

The timed queries read a stored export, as the views do: it is built from the driver's tables once, untimed, and
written by ``store_export``. Each query runs once to warm up and then twice; the faster run counts. The same queries
straight from the driver's tables, joins of the fixture included, are reported under ``from_tables``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql.types import DecimalType

from fixture import queries
from fixture import tables as t
from tallybook.session import configure
from tallybook.sources.tables import read_export, store_export

SKIPPED = {"sum_costs_month_two_scans", "sum_costs_month_by_project_two_scans"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/export"
    start = time.time()
    store_export(t.export(spark, sf_dir), folder)
    built = time.time() - start

    def stored(s: SparkSession, d: str):
        return read_export(s, folder, DecimalType(18, 4))

    def seconds(build) -> float:
        times = []
        for _ in range(runs + 1):
            start = time.time()
            queries.presented(build(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        return round(min(times[1:]), 3)

    timed = {name: seconds(q) for name, q in queries.view_queries(stored).items() if name not in SKIPPED}
    straight = {
        name: seconds(q) for name, q in queries.view_queries(t.export).items() if name in ("billing_gcp", "cost_by_account")
    }
    print(
        json.dumps(
            {
                "metric": "view queries over a stored export, total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "export_build_sec": round(built, 3),
                "from_tables": straight,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
