"""Time the headline queries; prints one JSON line.

Each query is written to Spark's no-op sink twice. `queries` holds the second run's
seconds, `first_run` the first one's, which include compilation. `full_refresh` reads
the tables, writes all five outputs and the rejects, and counts them.
"""

import json
import os
import time
import uuid

from pyspark.sql import SparkSession

from cartloom.plans.refresh import refresh
from cartloom.plans.staging import release, shared_folder
from cartloom.queries import QUERIES
from cartloom.sources.star import typed_sources

HEADLINE = [
    "master_table",
    "load_master",
    "master_rejects",
    "sales_summary",
    "delivery_summary",
    "product_summary",
    "state_summary",
    "state_summary_of_master",
    "summary_row_ids",
    "run_row_counts",
    "customers_page",
    "products_page",
    "orders_by_status",
    "customer_orders",
    "stats_summary",
    "top_states",
    "records_json",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out_dir = f"{shared_folder(spark)}/cartloom-bench-{uuid.uuid4().hex}"

    def drain(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    jobs = {name: lambda name=name: drain(name) for name in HEADLINE}
    jobs["full_refresh"] = lambda: refresh(
        spark, typed_sources(spark, sf_dir), out_dir
    ).rows.collect()

    runs = ({}, {})
    for seconds in runs:
        for name, job in jobs.items():
            started = time.perf_counter()
            job()
            seconds[name] = round(time.perf_counter() - started, 3)
    release(spark)
    spark.stop()
    first, second = runs
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
