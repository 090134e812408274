"""Global statistics over the sources as read, before cleaning."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.amounts import cents, mean_amount, money
from cartloom.schemas import SOURCES

TOP_STATES = 10


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row (table, rows) per frame."""
    counts = [
        df.agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def source_totals(sources: dict[str, DataFrame]) -> DataFrame:
    """The four row counts side by side."""
    return row_counts(sources).agg(
        *[
            F.max(F.when(F.col("table") == name, F.col("rows"))).alias(f"total_{name}")
            for name in SOURCES
        ]
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; ties in value order, missing values left out."""
    present = df.filter(F.col(column).isNotNull())
    return _per_value(present, column).orderBy(F.desc("count"), column)


def order_status_breakdown(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "order_status")


def top_states(customers: DataFrame, limit: int = TOP_STATES) -> DataFrame:
    return value_counts(customers, "customer_state").limit(limit)


def revenue(payments: DataFrame) -> DataFrame:
    """Total and mean payment over the raw payments, so without fan-out."""
    return _revenue(payments).drop("payments")


def _revenue(payments: DataFrame) -> DataFrame:
    value = cents(F.col("payment_value"), payments.schema["payment_value"].dataType)
    total, present = F.sum(value), F.count(value)
    return payments.agg(
        F.count("*").alias("payments"),
        money(F.coalesce(total, F.lit(0))).alias("total_revenue"),
        mean_amount(total, present, "decimal(28,6)").alias("average_payment"),
    )


def _metric(name: str, key: Column, value: Column) -> Column:
    return F.struct(
        F.lit(name).alias("metric"),
        key.cast("string").alias("key"),
        value.cast("decimal(28,6)").alias("value"),
    )


def summary(sources: dict[str, DataFrame]) -> DataFrame:
    """All statistics as rows (metric, key, value), each source read once.

    A statistic is left out where its source is empty or lacks the column; totals are
    then 0.
    """
    spark = sources["orders"].sparkSession
    no_key, n = F.lit(None), F.col("count")
    totals = [_metric(f"total_{name}", no_key, F.lit(0)) for name in SOURCES]
    parts = [spark.range(1).select(F.inline(F.array(*totals)))]

    items = sources["order_items"].agg(F.count("*").alias("count"))
    parts.append(items.select(F.inline(F.array(_metric("total_order_items", no_key, n)))))

    orders = _per_value(sources["orders"], "order_status")
    both = F.array(
        _metric("total_orders", no_key, n),
        _metric("order_status_breakdown", F.col("order_status"), n),
    )
    unknown = (F.col("metric") == "order_status_breakdown") & F.col("key").isNull()
    parts.append(orders.select(F.inline(both)).filter(~unknown))

    # Customers without a state sort behind all others, so the cut meets them last.
    customers = _per_value(sources["customers"], "customer_state")
    state = F.col("customer_state")
    top = customers.orderBy(state.isNull(), n.desc(), state).limit(TOP_STATES)
    top = top.select(F.inline(F.array(_metric("customers_by_state", state, n))))
    total = customers.agg(F.sum(n).alias("count"))
    parts.append(total.select(F.inline(F.array(_metric("total_customers", no_key, n)))))
    parts.append(top.filter(F.col("key").isNotNull()))

    payments = sources["payments"]
    if "payment_value" not in payments.columns:
        payments = payments.withColumn("payment_value", F.lit(None).cast("decimal(12,2)"))
        wanted = F.col("metric") == "total_payments"
    else:
        wanted = (F.col("metric") == "total_payments") | (F.col("payments") > 0)
    amounts = F.array(
        _metric("total_payments", no_key, F.col("payments")),
        *[_metric(c, no_key, F.col(c)) for c in ("total_revenue", "average_payment")],
    )
    parts.append(
        _revenue(payments)
        .select("payments", F.inline(amounts))
        .filter(wanted)
        .select("metric", "key", "value")
    )
    return (
        reduce(DataFrame.unionAll, parts)
        .groupBy("metric", "key")
        .agg(F.sum("value").cast("decimal(28,6)").alias("value"))
    )


def _per_value(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, missing values included; one group if the column is absent."""
    value = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.select(value.alias(column)).groupBy(column).agg(F.count("*").alias("count"))
