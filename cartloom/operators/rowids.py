"""Consecutive row numbers in key order without sorting in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.plans.staging import stage

_POSITION_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition above, position below


def number_few(df: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """Add 1, 2, 3, ... in ascending key order, in one task: for a row per state."""
    return df.select(F.row_number().over(Window.orderBy(*keys)).cast("long").alias(name), "*")


def number_rows(
    df: DataFrame, keys: list[str], name: str = "id", copies: bool = False
) -> DataFrame:
    """Add 1, 2, 3, ... in ascending key order.

    Rows are range-partitioned and sorted within partitions; a row's number is its
    position plus the rows of all earlier partitions. The sorted rows are written
    first, because range bounds are sampled and may differ if computed twice.

    Say `copies` where keys repeat: the position in the input then breaks ties, so
    that many rows of one key spread over partitions. Such input must come from files.
    """
    columns = df.columns
    if copies:
        df, keys = df.withColumn("_tie", F.monotonically_increasing_id()), [*keys, "_tie"]
    rows = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_pos"),
        ),
        "numbered",
    )
    # One row per partition, so neither the window nor the broadcast grows with the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return rows.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_pos") + 1).alias(name), *columns
    )
