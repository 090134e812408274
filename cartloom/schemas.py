"""Names, id rules and output contracts of the order data."""

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StructField,
    StructType,
    TimestampNTZType,
    VarcharType,
)

SOURCES = ("customers", "orders", "order_items", "payments")

# Columns each source is known by. Any further column rides along until load.
SOURCE_COLUMNS = {
    "customers": [
        "customer_id",
        "customer_city",
        "customer_state",
        "customer_zip_code_prefix",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
    ],
    "order_items": ["order_id", "product_id", "price", "freight_value"],
    "payments": ["order_id", "payment_type", "payment_value"],
}

# A row without one of these cannot be joined and is dropped first.
CRITICAL_IDS = {
    "customers": ["customer_id"],
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id"],
    "payments": ["order_id"],
}

# The texts that a CSV column uses for "missing".
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _contract(**columns):
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


_AMOUNT = DecimalType(12, 2)
_MONEY = DecimalType(28, 2)  # sums over repeated payments outgrow DECIMAL(10,2)
_DAYS = DecimalType(10, 2)

# Output columns in table order, with their declared widths.
MASTER = _contract(
    order_id=VarcharType(50),
    customer_id=VarcharType(50),
    customer_city=VarcharType(100),
    customer_state=VarcharType(10),
    customer_zip_code_prefix=VarcharType(20),
    order_status=VarcharType(50),
    order_purchase_timestamp=TimestampNTZType(),
    order_delivered_customer_date=TimestampNTZType(),
    price=_AMOUNT,
    freight_value=_AMOUNT,
    payment_type=VarcharType(50),
    payment_value=_AMOUNT,
    product_id=VarcharType(50),
)

SALES_SUMMARY = _contract(
    customer_id=VarcharType(50),
    customer_state=VarcharType(10),
    customer_city=VarcharType(100),
    total_spent=_MONEY,
    total_orders=LongType(),
    total_items=LongType(),
    avg_order_value=_MONEY,
    avg_price=_MONEY,
    avg_freight=_MONEY,
)

DELIVERY_SUMMARY = _contract(
    customer_state=VarcharType(10),
    total_orders=LongType(),
    delivered_orders=LongType(),
    delivery_rate=DecimalType(5, 2),
    avg_delivery_days=_DAYS,
    median_delivery_days=_DAYS,
    fastest_delivery=IntegerType(),
    slowest_delivery=IntegerType(),
    std_delivery_days=_DAYS,
)

PRODUCT_SUMMARY = _contract(
    product_id=VarcharType(50),
    total_orders=LongType(),
    total_items_sold=LongType(),
    total_revenue=_MONEY,
    avg_price=_MONEY,
    total_freight=_MONEY,
    avg_freight=_MONEY,
)

STATE_SUMMARY = _contract(
    customer_state=VarcharType(10),
    total_customers=LongType(),
    total_orders=LongType(),
    total_revenue=_MONEY,
    avg_order_value=_MONEY,
    total_items=LongType(),
)

# Key columns of each summary; its rows are numbered in this order.
SUMMARY_KEYS = {
    "sales_summary": ["customer_id", "customer_state", "customer_city"],
    "delivery_summary": ["customer_state"],
    "product_summary": ["product_id"],
    "state_summary": ["customer_state"],
}

CONTRACTS = {
    "order_master": MASTER,
    "sales_summary": SALES_SUMMARY,
    "delivery_summary": DELIVERY_SUMMARY,
    "product_summary": PRODUCT_SUMMARY,
    "state_summary": STATE_SUMMARY,
}
