"""Time queries over data with a hot key, split and whole; prints one JSON line.

The data come from the test tables: every line COPIES times, a third of them moved to one
order, which has PAYMENTS payments, and a third of the orders moved to one customer.
"""

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartloom.operators import facts, joins, marts
from cartloom.operators.clean import clean
from cartloom.operators.skew import CELL_ROWS, SkewProfile
from cartloom.plans.staging import release, stage
from cartloom.sources.star import typed_sources

COPIES, PAYMENTS = 10, 12


def skewed(spark, sf_dir):
    frames = typed_sources(spark, sf_dir)
    items, orders, payments = frames["order_items"], frames["orders"], frames["payments"]
    hot_order, hot_customer = F.lit("1"), F.lit("1")
    third = F.pmod(F.monotonically_increasing_id(), F.lit(3)) == 0
    items = items.select("*", F.explode(F.array_repeat(F.lit(0), COPIES))).drop("col")
    items = items.withColumn("order_id", F.when(third, hot_order).otherwise(F.col("order_id")))
    other = F.when(third, hot_customer).otherwise(F.col("customer_id"))
    extra = payments.limit(PAYMENTS).withColumn("order_id", hot_order)
    made = {
        "customers": frames["customers"],
        "orders": orders.withColumn("customer_id", other),
        "order_items": items,
        "payments": payments.unionByName(extra),
    }
    return {name: stage(df, f"skewed-{name}") for name, df in made.items()}


def queries(frames, cell_rows):
    kept = clean(frames)

    def master():
        return joins.master_table(kept, SkewProfile(frames, kept, cell_rows))

    def product():
        profile = SkewProfile(frames, kept, cell_rows)
        return marts.product_summary(facts.product_facts(kept, profile))

    return {"master_table": master, "product_summary": product}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    frames, seconds = skewed(spark, sf_dir), {}
    for _ in range(2):  # the second run counts
        for name, cells in (("whole", 1 << 62), ("split", CELL_ROWS)):
            for query, build in queries(frames, cells).items():
                started = time.perf_counter()
                df = build()
                planned = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                found, run = planned - started, time.perf_counter() - planned
                seconds[f"{query}, {name}"] = {"search": round(found, 1), "query": round(run, 1)}
    release(spark)
    spark.stop()
    print(json.dumps(seconds))


if __name__ == "__main__":
    main()
