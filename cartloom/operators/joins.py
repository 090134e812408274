"""The left-join chain orders, customers, order items, payments.

Every item of an order meets every payment of it, so the master table holds
items x payments rows per order. That product is part of the result.
"""

from pyspark.sql import DataFrame

from cartloom.operators.skew import HotKeys, SkewProfile, left_join, spread

Frames = dict[str, DataFrame]


def order_customer(
    clean: Frames, skew: SkewProfile, by_order: HotKeys = HotKeys("order_id")
) -> DataFrame:
    """Orders with their customer; orders of an unknown customer stay.

    Orders are dealt for a later join on `by_order` too while still in file order.
    """
    by_customer = skew.hot("customer_id", "orders", "customers")
    orders = spread(spread(clean["orders"], "orders", by_order), "orders", by_customer)
    return left_join(orders, {"customers": clean["customers"]}, by_customer)


def order_item_join(clean: Frames, skew: SkewProfile) -> DataFrame:
    skew.rows("customers", "orders", "order_items")
    by_order = skew.hot("order_id", "orders", "order_items")
    base = order_customer(clean, skew, by_order)
    return left_join(base, {"order_items": clean["order_items"]}, by_order)


def master_table(clean: Frames, skew: SkewProfile) -> DataFrame:
    """The wide table. Items and payments join in one stage, each shuffled once."""
    skew.rows("customers", "orders", "order_items", "payments")
    by_order = skew.hot("order_id", "orders", "order_items", "payments")
    base = order_customer(clean, skew, by_order)
    sides = {name: clean[name] for name in ("order_items", "payments")}
    return left_join(base, sides, by_order)
