"""What each order and product contributes to the summaries, without the fan-out.

Summaries are defined over master rows, where an order with i items and p payments
appears max(i,1) x max(p,1) times. Totals per order are taken first and multiplied,
so the product is never built. The same columns can be read off a master table
row by row; the summaries accept either.

`rows` counts master rows; `<amount>_cents` and `<amount>_n` are the sum and the
number of present values over them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.amounts import cents
from cartloom.functions.missing import all_present
from cartloom.operators.joins import Frames
from cartloom.operators.skew import SkewProfile, left_join, spread

CUSTOMER_KEYS = ["customer_id", "customer_state", "customer_city"]
ITEM_AMOUNTS = {"price": "price", "freight": "freight_value"}
PAYMENT_AMOUNTS = {"payment": "payment_value"}


def _cents(df: DataFrame, amounts: dict[str, str]) -> list[Column]:
    return [
        cents(F.col(column), df.schema[column].dataType).alias(f"{name}_cents")
        for name, column in amounts.items()
    ]


def measures(*amounts: str) -> list[str]:
    return [f"{name}_{part}" for name in amounts for part in ("cents", "n")]


def _totals(df: DataFrame, keys: list[str], amounts: dict[str, str], count: str) -> DataFrame:
    """Row count, cent sum and present values per key; combined before the shuffle."""
    parts = []
    for name in amounts:
        parts.append(F.sum(f"{name}_cents").alias(f"{name}_cents"))
        parts.append(F.count(f"{name}_cents").alias(f"{name}_n"))
    rows = df.select(*keys, *_cents(df, amounts))
    return rows.groupBy(*keys).agg(F.count("*").alias(count), *parts)


def item_totals(order_items: DataFrame) -> DataFrame:
    return _totals(order_items, ["order_id"], ITEM_AMOUNTS, "items")


def payment_totals(payments: DataFrame) -> DataFrame:
    return _totals(payments, ["order_id"], PAYMENT_AMOUNTS, "payments")


def _at_least_one(count: str) -> Column:
    return F.greatest(F.coalesce(F.col(count), F.lit(0)), F.lit(1))


def _times(names: list[str], factor: Column) -> list[Column]:
    return [(F.coalesce(F.col(c), F.lit(0)) * factor).alias(c) for c in names]


def homes(clean: Frames, keys: list[str]) -> DataFrame:
    """Customers as distinct (customer_id, keys) with how often each is listed: copies."""
    return clean["customers"].groupBy("customer_id", *keys).agg(F.count("*").alias("copies"))


def at_home(rows: DataFrame, clean: Frames, keys: list[str]) -> DataFrame:
    """Rows with customer_id beside the home of their customer, once per distinct home.

    A customer listed often weighs by copies instead of repeating the rows; a customer
    with very many rows is on the outer side, which adaptive execution splits. Rows of an
    unknown customer stay, with one copy.
    """
    joined = rows.join(homes(clean, keys), "customer_id", "left")
    return joined.withColumn("copies", F.coalesce("copies", F.lit(1)))


def order_facts(clean: Frames, skew: SkewProfile, keys: list[str]) -> DataFrame:
    """One row per order and group keys: order_id, keys, rows, sums.

    The keys are columns of the order's customer. By customer_id alone no customer is
    looked up, and repeats of a customer do not count yet.
    """
    by_order = skew.hot("order_id", "orders")
    orders = clean["orders"].select("order_id", "customer_id")
    base = spread(orders, "orders", by_order)
    home = [k for k in keys if k != "customer_id"]
    base = at_home(base, clean, home) if home else base.withColumn("copies", F.lit(1).cast("long"))
    totals = {
        "items": item_totals(clean["order_items"]),
        "payments": payment_totals(clean["payments"]),
    }
    joined = left_join(base, totals, by_order)
    weighted = joined.withColumns({c: _at_least_one(c) for c in ("items", "payments")})
    rows = weighted.select(
        "order_id",
        *keys,
        (F.col("items") * F.col("payments") * F.col("copies")).alias("rows"),
        *_times(measures("payment"), F.col("items") * F.col("copies")),
        *_times(measures("price", "freight"), F.col("payments") * F.col("copies")),
    )
    return one_per_order(rows, keys)


def one_per_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add up repeats of an order and keys; local where rows are partitioned by order."""
    names = ["rows", *measures(*PAYMENT_AMOUNTS, *ITEM_AMOUNTS)]
    return rows.groupBy("order_id", *keys).agg(*sums(names))


def state_facts(customer_facts: DataFrame, clean: Frames) -> DataFrame:
    """Order facts per state from those per customer."""
    located = at_home(customer_facts, clean, ["customer_state"])
    names = ["rows", *measures(*PAYMENT_AMOUNTS, *ITEM_AMOUNTS)]
    rows = located.select("order_id", "customer_state", *_times(names, F.col("copies")))
    return one_per_order(rows, ["customer_state"])


def totals_per_key(
    facts: DataFrame, keys: list[str], names: tuple[str, ...] = ("payment", "price", "freight")
) -> DataFrame:
    """Sums and number of orders per key, of facts with one row per order and keys.

    Rows with a missing key form no group.
    """
    return (
        facts.filter(all_present(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("total_orders"), *sums(["rows", *measures(*names)]))
    )


def customer_totals(customer_facts: DataFrame, clean: Frames) -> DataFrame:
    """Totals per customer, state and city from order facts per customer_id.

    Orders are summed per customer before customers join, so a customer with very many
    orders, or one listed very often, is a single row by then.
    """
    totals = totals_per_key(customer_facts, ["customer_id"])
    home = homes(clean, CUSTOMER_KEYS[1:]).filter(all_present(CUSTOMER_KEYS))
    names = ["rows", *measures(*PAYMENT_AMOUNTS, *ITEM_AMOUNTS)]
    return home.join(totals, "customer_id").select(
        *CUSTOMER_KEYS, "total_orders", *_times(names, F.col("copies"))
    )


def sums(names: list[str]) -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]


def product_facts(clean: Frames, skew: SkewProfile) -> DataFrame:
    """One row per item of a known order: order_id, product_id, rows, sums.

    An item counts once per payment of its order, and again for every repeat of the
    order or of its customer.
    """
    payments = clean["payments"].groupBy("order_id").agg(F.count("*").alias("payments"))
    weights = (
        _order_copies(clean, skew)
        .join(payments, "order_id", "left")
        .select("order_id", (F.col("copies") * _at_least_one("payments")).alias("rows"))
    )
    by_order = skew.hot("order_id", "order_items")
    # Only the key test precedes the dealing of hot rows; file order is unchanged by it.
    items = clean["order_items"].filter(F.col("product_id").isNotNull())
    items = items.select("order_id", "product_id", *_cents(items, ITEM_AMOUNTS))
    items = spread(items, "order_items", by_order)
    joined = left_join(items, {"weights": weights}, by_order, "inner")
    present = {f"{name}_n": _present(name) for name in ITEM_AMOUNTS}
    return joined.withColumns(present).select(
        "order_id", "product_id", "rows", *_times(measures(*ITEM_AMOUNTS), F.col("rows"))
    )


def _order_copies(clean: Frames, skew: SkewProfile) -> DataFrame:
    """How often each order id stands in the table of orders with their customers.

    Customers matter only where one is listed twice, so orders meet those few, if
    there are any, instead of being shuffled to all customers.
    """
    orders = clean["orders"].select("order_id", "customer_id")
    repeated = skew.repeated("customer_id", "customers")
    if repeated is None:
        return orders.groupBy("order_id").agg(F.count("*").alias("copies"))
    return (
        orders.join(repeated, "customer_id", "left")
        .groupBy("order_id")
        .agg(F.sum(F.coalesce(F.col("copies"), F.lit(1))).alias("copies"))
    )


def _present(name: str) -> Column:
    return F.when(F.col(f"{name}_cents").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")


def facts_of_master(master: DataFrame) -> DataFrame:
    """The same columns for every row of a built master table, each counting once."""
    amounts = ITEM_AMOUNTS | PAYMENT_AMOUNTS
    rows = master.select(
        "order_id",
        "product_id",
        *CUSTOMER_KEYS,
        F.lit(1).cast("long").alias("rows"),
        *_cents(master, amounts),
    )
    return rows.withColumns({f"{name}_n": _present(name) for name in amounts})


def buyers(clean: Frames) -> DataFrame:
    """Distinct customers with an order, per state: customer_state, total_customers.

    Both sides shrink to distinct ids before they are shuffled, so neither a customer
    with very many orders nor one listed very often weighs on a task.
    """
    homes = clean["customers"].filter(F.col("customer_state").isNotNull())
    return (
        homes.select("customer_id", "customer_state")
        .distinct()
        .join(clean["orders"].select("customer_id").distinct(), "customer_id", "left_semi")
        .groupBy("customer_state")
        .agg(F.count("*").alias("total_customers"))
    )


def groups(clean: Frames) -> dict[str, DataFrame]:
    """The distinct keys of each summary: what its rows are, without what they sum."""
    orders = clean["orders"].select("order_id", "customer_id")
    customers = clean["customers"].join(orders.select("customer_id").distinct(), "customer_id", "left_semi")
    states = customers.filter(all_present(["customer_state"])).select("customer_state").distinct()
    sold = clean["order_items"].filter(all_present(["product_id"])).select("order_id", "product_id")
    known = sold.distinct().join(orders.select("order_id").distinct(), "order_id", "left_semi")
    return {
        "sales_summary": customers.filter(all_present(CUSTOMER_KEYS)).select(*CUSTOMER_KEYS).distinct(),
        "delivery_summary": states,
        "product_summary": known.select("product_id").distinct(),
        "state_summary": states,
    }


def buyers_of_master(master: DataFrame) -> DataFrame:
    return (
        master.filter(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count_distinct("customer_id").alias("total_customers"))
    )
