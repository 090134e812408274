"""Serve the four sources from a star schema of Parquet tables.

`typed_sources` gives typed columns; `text_sources` gives the same rows as a
delimited file would hold them, with the flaws such files have. Every row of the
underlying tables is used. Flaws hang on measured attributes (account balance,
order total, line price, tax), so they are spread over the whole table:

* accounts below -900 have no id, the next band no state, the next no city;
* the cheapest orders lack an order id or customer id;
* the cheapest lines lack an order id, some untaxed ones a product, others a price;
* the dearest orders have a payment that belongs to no order;
* urgent and high-priority orders pay a second time, by voucher.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.dates import timestamp_text

_AMOUNT = "decimal(12,2)"

# Columns used, declared so that no job has to read them off the files.
_TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double",
}


def _id(column: str) -> Column:
    return F.col(column).cast("string")


def _unless(missing: Column, value: Column) -> Column:
    return F.when(~missing, value)


def typed_sources(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    def table(name):
        return spark.read.schema(_TABLES[name]).parquet(f"{directory}/{name}.parquet")

    balance, total = F.col("c_acctbal"), F.col("o_totalprice")
    discount, tax = F.col("l_discount"), F.col("l_tax")

    key = _id("c_custkey")
    customers = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _unless(balance < -900, _id("c_custkey")).alias("customer_id"),
            _unless(balance.between(-900, -850), F.col("n_name")).alias("customer_state"),
            _unless(
                balance.between(-849, -800), F.concat("n_name", F.lit("-"), "c_mktsegment")
            ).alias("customer_city"),
            F.lpad(key, F.greatest(F.length(key), F.lit(5)), F.lit("0")).alias("customer_zip_code_prefix"),
        )
    )

    placed = F.col("o_orderdate")
    early_hours = (F.col("o_orderkey") % 24).cast("int")
    delivery_hours = ((F.col("o_orderkey") * 37) % 720 - 24).cast("int")
    orders = table("orders").select(
        _unless(total < 1500, _id("o_orderkey")).alias("order_id"),
        _unless(total.between(1500, 2500), _id("o_custkey")).alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        (placed + F.make_dt_interval(hours=early_hours)).alias("order_purchase_timestamp"),
        _unless(
            F.col("o_orderstatus") == "P", placed + F.make_dt_interval(hours=delivery_hours)
        ).alias("order_delivered_customer_date"),
    )

    order_items = table("lineitem").select(
        _unless(F.col("l_extendedprice") < 1000, _id("l_orderkey")).alias("order_id"),
        _unless((discount < 0.005) & (tax < 0.005), _id("l_partkey")).alias("product_id"),
        _unless(
            (discount > 0.095) & (tax > 0.075), F.col("l_extendedprice").cast(_AMOUNT)
        ).alias("price"),
        _unless(
            (F.col("l_quantity") > 49.5) & (tax > 0.075), F.col("l_quantity").cast(_AMOUNT)
        ).alias("freight_value"),
    )

    main = F.struct(
        F.col("o_orderpriority").alias("payment_type"),
        _unless(total.between(480000, 482000), total.cast(_AMOUNT)).alias("payment_value"),
    )
    voucher = F.struct(
        F.lit("voucher").alias("payment_type"),
        F.lit("1.25").cast(_AMOUNT).alias("payment_value"),
    )
    pays_twice = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    payments = table("orders").select(
        _unless(total > 490000, _id("o_orderkey")).alias("order_id"),
        F.inline(F.when(pays_twice, F.array(main, voucher)).otherwise(F.array(main))),
    )

    return {
        "customers": customers,
        "orders": orders,
        "order_items": order_items,
        "payments": payments,
    }


def text_sources(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    typed = typed_sources(spark, directory)

    customers = typed["customers"].select(
        F.coalesce("customer_id", F.lit("NA")).alias("customer_id"),
        F.coalesce("customer_state", F.lit("null")).alias("customer_state"),
        F.coalesce("customer_city", F.lit("")).alias("customer_city"),
        "customer_zip_code_prefix",
    )

    hour = F.extract(F.lit("HOUR"), F.col("order_purchase_timestamp"))
    first_of_month = F.extract(F.lit("DAY"), F.col("order_purchase_timestamp")) == 1
    orders = typed["orders"].select(
        F.when((hour == 23) & first_of_month, F.rpad("order_id", 60, "x"))
        .otherwise(F.coalesce("order_id", F.lit("None")))
        .alias("order_id"),
        F.coalesce("customer_id", F.lit("NULL")).alias("customer_id"),
        "order_status",
        timestamp_text(F.col("order_purchase_timestamp")).alias("order_purchase_timestamp"),
        F.when((hour == 22) & first_of_month, F.lit("soon"))
        .otherwise(F.coalesce(timestamp_text(F.col("order_delivered_customer_date")), F.lit("")))
        .alias("order_delivered_customer_date"),
    )

    freight = F.col("freight_value")
    order_items = typed["order_items"].select(
        F.coalesce("order_id", F.lit("<NA>")).alias("order_id"),
        F.coalesce("product_id", F.lit("n/a")).alias("product_id"),
        F.when((freight == 49) & F.col("price").isNotNull(), F.lit("x"))
        .when((freight == 48) & F.col("product_id").isNull(), F.lit("99999999999.00"))
        .otherwise(F.coalesce(F.col("price").cast("string"), F.lit("NaN")))
        .alias("price"),
        F.coalesce(freight.cast("string"), F.lit("nan")).alias("freight_value"),
    )

    payments = typed["payments"].select(
        F.coalesce("order_id", F.lit("")).alias("order_id"),
        "payment_type",
        F.coalesce(F.col("payment_value").cast("string"), F.lit("N/A")).alias("payment_value"),
    )

    return {
        "customers": customers,
        "orders": orders,
        "order_items": order_items,
        "payments": payments,
    }
