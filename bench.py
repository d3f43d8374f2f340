"""Time the report catalogue and the load that feeds it; prints one JSON line.

The whole load runs once (`full_load`: staging, star schema, gates), then every report reads its
tables, as in production. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; with BENCH_COLD=1 the line
also has the first run of each report.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tallyhouse.checks import QUERIES
from tallyhouse.checks.registry import Inputs
from tallyhouse.plans.full_load import Warehouse, run_full
from tallyhouse.session import shared_folder

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
OPERATORS = (
    "m09_fact_orders", "m12_scd2_merge", "m13_carved_images", "c04_reject_reasons", "c06_unseen_events",
    "c08_orders_after_changes", "c08_lines_after_changes", "c17_winners",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallyhouse-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    spark.range(1000).selectExpr("sum(id)").collect()
    inputs = Inputs.of(spark, FOLDER)
    house = Warehouse(spark, f"{shared_folder(spark)}/bench")
    seconds = {"full_load": timed(lambda: run_full(house, inputs.staged))}
    inputs.adopt(house)
    reports = [name for name in QUERIES if name[0] in "bhv" and name[1:3].isdigit()]
    cold = {}
    for name in [*reports, *OPERATORS]:

        def run(name=name):
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

        cold[name] = timed(run)
        seconds[name] = timed(run)
    line = {
        "metric": "tallyhouse_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_COLD") == "1":
        line["cold"] = cold
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
