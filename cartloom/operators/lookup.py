"""Filtered and paged reads of single sources.

File order means nothing in a distributed scan, so pages are cut from rows sorted
by the table's key and then by every other column.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

DEFAULT_LIMIT = 100
TOP_ROWS = 10_000  # rows of each task that may meet in one to be merged


class SourceUnavailable(LookupError):
    """The source has no rows to read."""


@dataclass(frozen=True)
class Listing:
    """Rows of one answer, all rows that matched, and the arguments echoed with them."""

    rows: DataFrame
    matched: DataFrame
    echo: dict = field(default_factory=dict)
    count_name: str = "total"
    none_found: str | None = None

    def count(self) -> DataFrame:
        return self.matched.agg(F.count("*").alias(self.count_name))

    def with_count(self) -> DataFrame:
        """Each row beside the number of matches."""
        return self.rows.withColumn(self.count_name, self.count().scalar())

    def answer(self) -> dict:
        """The answer as a dict; `data` stays a DataFrame, however many rows it has."""
        total = self.count().first()[0]
        if self.none_found is not None and not total:
            return {"message": self.none_found, "data": self.rows}
        return {**self.echo, self.count_name: total, "data": self.rows}


def page(df: DataFrame, keys: list[str], limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """Rows offset+1 to offset+limit in key order.

    A page that ends within the first TOP_ROWS rows is cut from each task's first rows.
    Deeper ones are found by ranges: rows are counted per range of all columns, and only
    the ranges that the page touches are sorted. What is kept to sort is the page and at
    most one range before it, at any depth. Tables that are paged often are best written
    as plans.pages.PagedTable.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
    order = keys + [c for c in df.columns if c not in keys]
    if not limit or offset + limit <= TOP_ROWS:
        return df.orderBy(*order).offset(offset).limit(limit)
    whole = F.struct(*order)
    ranges = (
        df.repartitionByRange(*order)
        .groupBy(F.spark_partition_id())
        .agg(F.count("*").alias("n"), F.min(whole).alias("low"), F.max(whole).alias("high"))
    )
    before, first, last, skipped = 0, None, None, 0
    for r in sorted(ranges.collect(), key=lambda r: r[0]):
        if before < offset + limit and before + r["n"] > offset:
            if first is None:
                first, skipped = r["low"], before
            last = r["high"]
        before += r["n"]
    if first is None:
        return df.limit(0)
    row = df.select(*order).schema
    bounds = StructType([StructField("low", row), StructField("high", row)])
    edges = df.sparkSession.createDataFrame([(first, last)], bounds)
    low, high = (edges.select(e).scalar() for e in ("low", "high"))
    touched = df.filter(whole.between(low, high))
    return touched.orderBy(*order).offset(offset - skipped).limit(limit)


def _available(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise SourceUnavailable(f"{name}: the source has no rows")
    return df


def _equals(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Exact, case-sensitive match; no filter for a missing or empty value."""
    return df.filter(F.col(column) == value) if value else df


def list_customers(
    customers: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0
) -> Listing:
    customers = _available(customers, "Customer")
    rows = page(customers, ["customer_id"], limit, offset)
    return Listing(rows, customers, {"limit": limit, "offset": offset})


def customers_by_state(customers: DataFrame, state: str) -> Listing:
    """Every customer of a state; the argument is upper-cased, the column is not."""
    found = _available(customers, "Customer").filter(F.col("customer_state") == state.upper())
    return Listing(
        found,
        found,
        {"state": state.upper()},
        "count",
        none_found=f"no customer lives in state {state}",
    )


def list_orders(
    orders: DataFrame, status: str | None = None, limit: int = DEFAULT_LIMIT
) -> Listing:
    found = _equals(_available(orders, "Orders"), "order_status", status)
    return Listing(page(found, ["order_id"], limit), found, {"limit": limit})


def list_order_items(
    order_items: DataFrame, order_id: str | None = None, limit: int = DEFAULT_LIMIT
) -> Listing:
    found = _equals(_available(order_items, "Order items"), "order_id", order_id)
    return Listing(page(found, ["order_id"], limit), found, {"limit": limit})


def list_payments(
    payments: DataFrame, payment_type: str | None = None, limit: int = DEFAULT_LIMIT
) -> Listing:
    found = _equals(_available(payments, "Payments"), "payment_type", payment_type)
    return Listing(page(found, ["order_id"], limit), found, {"limit": limit})


def customer_orders(orders: DataFrame, customer_id: str) -> Listing:
    """Every order of one customer."""
    found = _available(orders, "Orders").filter(F.col("customer_id") == customer_id)
    return Listing(
        found,
        found,
        {"customer_id": customer_id},
        "order_count",
        none_found=f"customer {customer_id} has no orders",
    )


def data_loaded(sources: dict[str, DataFrame]) -> DataFrame:
    """Which sources have rows. Each check stops at the first row found."""
    flags = [(name, not df.isEmpty()) for name, df in sources.items()]
    spark = next(iter(sources.values())).sparkSession
    return spark.createDataFrame(flags, "source string, loaded boolean")
