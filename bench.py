"""Times the registered queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. The tables that the
Gold queries read are built first and timed on their own as `build_silver` and `build_gold`; each query is then
run once, to completion, with its result discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tallylake.catalog.lake import lake
from tallylake.catalog.queries import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallylake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr)

    spark.read.parquet(f"{sf_dir}/events.parquet").count()  # starts the executors
    tables = lake(spark, sf_dir)
    timed("build_silver", lambda: tables.silver_path)
    timed("build_gold", lambda: tables.gold)
    timed("land_messages", lambda: tables.messages_path)
    for name in wanted:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
