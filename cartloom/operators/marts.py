"""The four summary tables.

Rows with a missing group key form no group. Distinct orders are counted by
grouping on order and key first: where the input is already partitioned by order
that step needs no shuffle, and the second one ships one row per group and task.
No summary shuffles one row per order for a distinct count.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions.amounts import exact_ratio, mean_money, money
from cartloom.functions.dates import strict_timestamp, whole_days
from cartloom.functions.missing import all_present
from cartloom.operators.facts import CUSTOMER_KEYS, at_home, measures, sums, totals_per_key
from cartloom.operators.joins import Frames
from cartloom.schemas import DELIVERY_SUMMARY, PRODUCT_SUMMARY, SALES_SUMMARY, STATE_SUMMARY


def _mean(name: str):
    return mean_money(F.col(f"{name}_cents"), F.col(f"{name}_n"))


def sales_summary(totals: DataFrame) -> DataFrame:
    """Per customer, from totals per customer keys; averages over nothing are 0."""

    def mean_or_zero(name):
        return F.coalesce(_mean(name), F.lit(0).cast("decimal(28,2)"))

    return totals.select(
        *CUSTOMER_KEYS,
        money(F.col("payment_cents")).alias("total_spent"),
        "total_orders",
        F.col("rows").alias("total_items"),
        mean_or_zero("payment").alias("avg_order_value"),
        mean_or_zero("price").alias("avg_price"),
        mean_or_zero("freight").alias("avg_freight"),
    ).select(SALES_SUMMARY.names)


def product_summary(facts: DataFrame) -> DataFrame:
    """Per product. Facts are per item, so they are added up per order first."""
    names = ("price", "freight")
    items = facts.filter(all_present(["product_id"]))
    per_order = items.groupBy("order_id", "product_id").agg(*sums(["rows", *measures(*names)]))
    groups = totals_per_key(per_order, ["product_id"], names)
    return groups.select(
        "product_id",
        "total_orders",
        F.col("rows").alias("total_items_sold"),
        money(F.col("price_cents")).alias("total_revenue"),
        _mean("price").alias("avg_price"),
        money(F.col("freight_cents")).alias("total_freight"),
        _mean("freight").alias("avg_freight"),
    ).select(PRODUCT_SUMMARY.names)


def state_summary(facts: DataFrame, buyers: DataFrame) -> DataFrame:
    """Per state. Facts are per order and state; `buyers` counts customers per state."""
    groups = totals_per_key(facts, ["customer_state"], ("payment",))
    return _state_columns(groups.join(buyers, "customer_state"))


def state_summary_of_rows(rows: DataFrame) -> DataFrame:
    """Per state, from the columns of facts_of_master(): one pass over a master table.

    Rows are added up per state, order and customer first, which is local where they are
    partitioned by order; both distinct counts are then taken of those groups.
    """
    names = ["rows", *measures("payment")]
    known = rows.filter(F.col("customer_state").isNotNull())
    groups = known.groupBy("order_id", "customer_id", "customer_state").agg(*sums(names))
    totals = groups.groupBy("customer_state").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct("order_id").alias("total_orders"),
        *sums(names),
    )
    return _state_columns(totals)


def _state_columns(groups: DataFrame) -> DataFrame:
    return groups.select(
        "customer_state",
        "total_customers",
        "total_orders",
        money(F.col("payment_cents")).alias("total_revenue"),
        _mean("payment").alias("avg_order_value"),
        F.col("rows").alias("total_items"),
    ).select(STATE_SUMMARY.names)


def with_delivery_days(orders: DataFrame) -> DataFrame:
    """Orders plus whole days from purchase to delivery, NULL where either is unknown."""

    def moment(name):
        return strict_timestamp(F.col(name), orders.schema[name].dataType)

    days = whole_days(moment("order_purchase_timestamp"), moment("order_delivered_customer_date"))
    return orders.withColumn("delivery_days", days)


def delivery_summary(clean: Frames) -> DataFrame:
    """Per state, one row per order (no fan-out).

    Orders are first counted per state and day, so every statistic, the exact median
    included, is taken over a histogram with one row per distinct day.
    """
    orders = with_delivery_days(clean["orders"]).select("customer_id", "delivery_days")
    histogram = (
        at_home(orders, clean, ["customer_state"])
        .filter(all_present(["customer_state"]))
        .groupBy("customer_state", F.col("delivery_days").alias("d"))
        .agg(F.sum("copies").alias("n"))
    )
    d, n = F.col("d"), F.col("n")
    groups = histogram.groupBy("customer_state").agg(
        F.sum(n).alias("total_orders"),
        F.coalesce(F.sum(F.when(d.isNotNull(), n)), F.lit(0)).alias("delivered_orders"),
        F.sum(d * n).alias("sum_d"),
        F.sum((d * n).cast("decimal(20,0)") * d).cast("decimal(38,0)").alias("sum_dd"),
        F.percentile(d, 0.5, n).cast("decimal(10,2)").alias("median_delivery_days"),
        F.min(d).alias("fastest_delivery"),
        F.max(d).alias("slowest_delivery"),
    )
    count, sum_d = F.col("delivered_orders"), F.col("sum_d").cast("decimal(19,0)")
    squares = count.cast("decimal(19,0)") * F.col("sum_dd") - sum_d * sum_d
    deviation = F.when(
        count > 1, F.sqrt(squares.cast("double") / count.cast("double") / (count - 1))
    )
    return groups.select(
        "*",
        exact_ratio(count * 100, F.col("total_orders"), "decimal(5,2)").alias("delivery_rate"),
        exact_ratio(F.col("sum_d"), count, "decimal(10,2)").alias("avg_delivery_days"),
        deviation.cast("decimal(10,2)").alias("std_delivery_days"),
    ).select(DELIVERY_SUMMARY.names)
