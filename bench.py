"""Time the headline queries over $BENCH_SF_DIR; prints one JSON line.

Each query is built and run to the end without collecting its rows. The first
pass warms the JVM up and is not counted; of the others the fastest counts.
"""
from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallystar.contract.queries import QUERIES  # noqa: E402
from tallystar.session import build_session  # noqa: E402

HEADLINES = (
    "staging", "dim_customer", "dim_product", "fact_sales", "sales_dataset",
    "mart_product_sales", "mart_customer_sales", "mart_time_sales", "mart_store_sales",
    "mart_supplier_sales", "mart_product_quality", "run_all",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tallystar-bench",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
         "spark.ui.showConsoleProgress": "false"},
        {"SPARK_MASTER_URL": f"local[{cpus}]", "SPARK_LOG_LEVEL": "ERROR"},
    )
    timings = {}
    for name in HEADLINES:
        runs = [seconds(spark, name, folder) for _ in range(REPEATS + 1)]
        timings[name] = round(min(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
