"""Every operator as a query over the star-schema tables of a directory."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.amounts import cents, exact_ratio, money
from cartloom.functions.missing import all_present, normalise_missing
from cartloom.functions.text import json_records, same_text
from cartloom.operators import facts, joins, load, lookup, marts, stats
from cartloom.operators.clean import clean
from cartloom.operators.rowids import number_rows
from cartloom.operators.skew import SkewProfile
from cartloom.plans import catalog, pages, skipping, versions
from cartloom.plans.staging import stage, staged_folder
from cartloom.schemas import CRITICAL_IDS, SUMMARY_KEYS
from cartloom.sources.star import text_sources, typed_sources

QUERIES = {}
LOOKUP_COLUMNS = ["order_id", "customer_id", "customer_state"]


def query(function):
    QUERIES[function.__name__] = function
    return function


class Shop:
    """The sources of one directory, cleaned, with their skew profile."""

    def __init__(self, sources: dict[str, DataFrame]):
        self.sources = sources
        self.frames = clean(sources)
        self.skew = SkewProfile(sources, self.frames)

    def master(self) -> DataFrame:
        return joins.master_table(self.frames, self.skew)

    def loaded(self) -> DataFrame:
        fitted = load.fit_sources(self.frames)
        return load.load_master(joins.master_table(fitted, self.skew))

    def order_facts(self, *keys) -> DataFrame:
        return facts.order_facts(self.frames, self.skew, list(keys))

    def state_summary(self) -> DataFrame:
        return marts.state_summary(self.order_facts("customer_state"), facts.buyers(self.frames))

    def product_facts(self) -> DataFrame:
        return facts.product_facts(self.frames, self.skew)


def shop(spark: SparkSession, sf_dir: str) -> Shop:
    return Shop(typed_sources(spark, sf_dir))


def text_shop(spark: SparkSession, sf_dir: str) -> Shop:
    """The same from raw texts, missing values normalised as after a file read."""
    texts = text_sources(spark, sf_dir)
    return Shop({name: normalise_missing(df) for name, df in texts.items()})


# Sources and cleaning


@query
def scan_counts(spark, sf_dir):
    return stats.row_counts(shop(spark, sf_dir).sources)


@query
def na_normalise(spark, sf_dir):
    return text_shop(spark, sf_dir).sources["customers"]


@query
def na_normalise_orders(spark, sf_dir):
    return text_shop(spark, sf_dir).sources["orders"]


@query
def na_normalise_order_items(spark, sf_dir):
    return text_shop(spark, sf_dir).sources["order_items"]


@query
def na_normalise_payments(spark, sf_dir):
    return text_shop(spark, sf_dir).sources["payments"]


@query
def clean_counts(spark, sf_dir):
    """Rows read and rows kept per source, in one scan of each."""
    counts = []
    for name, df in shop(spark, sf_dir).sources.items():
        counts.append(
            df.agg(
                F.lit(name).alias("table"),
                F.count("*").alias("rows"),
                F.count_if(all_present(CRITICAL_IDS[name])).alias("kept"),
            )
        )
    first, *rest = counts
    for part in rest:
        first = first.unionAll(part)
    return first


@query
def data_loaded(spark, sf_dir):
    return lookup.data_loaded(shop(spark, sf_dir).sources)


# Joins


@query
def order_customer(spark, sf_dir):
    s = shop(spark, sf_dir)
    return joins.order_customer(s.frames, s.skew)


@query
def order_item_join(spark, sf_dir):
    s = shop(spark, sf_dir)
    return joins.order_item_join(s.frames, s.skew)


@query
def master_table(spark, sf_dir):
    return shop(spark, sf_dir).master()


# Load contract


@query
def load_master(spark, sf_dir):
    return load.accepted(text_shop(spark, sf_dir).loaded())


@query
def master_rejects(spark, sf_dir):
    return load.rejected(text_shop(spark, sf_dir).loaded())


@query
def reject_samples(spark, sf_dir):
    """Five rejected rows of each reason."""
    return load.reject_samples(load.rejected(text_shop(spark, sf_dir).loaded()))


@query
def delivery_days(spark, sf_dir):
    orders = text_shop(spark, sf_dir).frames["orders"]
    return marts.with_delivery_days(orders).select("order_id", "customer_id", "delivery_days")


# Summaries


@query
def sales_summary(spark, sf_dir):
    s = shop(spark, sf_dir)
    return marts.sales_summary(facts.customer_totals(s.order_facts("customer_id"), s.frames))


@query
def sales_summary_of_master(spark, sf_dir):
    """The sales summary taken from the built master table."""
    rows = facts.facts_of_master(shop(spark, sf_dir).master())
    per_order = facts.one_per_order(rows, facts.CUSTOMER_KEYS)
    return marts.sales_summary(facts.totals_per_key(per_order, facts.CUSTOMER_KEYS))


@query
def delivery_summary(spark, sf_dir):
    s = shop(spark, sf_dir)
    return marts.delivery_summary(s.frames)


@query
def product_summary(spark, sf_dir):
    return marts.product_summary(shop(spark, sf_dir).product_facts())


@query
def state_summary(spark, sf_dir):
    return shop(spark, sf_dir).state_summary()


@query
def fanout_preagg(spark, sf_dir):
    """Per state, the fan-out computed from per-order totals without building it."""
    return _fanout(shop(spark, sf_dir).order_facts("customer_state"))


@query
def fanout_rows(spark, sf_dir):
    """The same read off the built master table, row by row."""
    return _fanout(facts.facts_of_master(shop(spark, sf_dir).master()))


def _fanout(order_facts):
    return (
        order_facts.filter(all_present(["customer_state"]))
        .groupBy("customer_state")
        .agg(
            F.sum("rows").alias("master_rows"),
            F.sum("payment_n").alias("payments"),
            money(F.sum("payment_cents")).alias("payment_total"),
            F.sum("price_n").alias("prices"),
            money(F.sum("price_cents")).alias("price_total"),
        )
    )


@query
def state_summary_of_master(spark, sf_dir):
    """The state summary taken from the built master table, which is read once."""
    return marts.state_summary_of_rows(facts.facts_of_master(shop(spark, sf_dir).master()))


@query
def summary_row_ids(spark, sf_dir):
    numbered = number_rows(
        marts.product_summary(shop(spark, sf_dir).product_facts()),
        SUMMARY_KEYS["product_summary"],
    )
    return numbered.select("id", "product_id", "total_orders")


@query
def run_row_counts(spark, sf_dir):
    """Rows read, merged, loaded, rejected and summarised by a full run.

    A summary has a row per group, so its keys are counted, not its sums taken.
    """
    s = text_shop(spark, sf_dir)
    counts = stats.row_counts({**s.sources, **facts.groups(s.frames)})
    outcome = load.outcome_counts(load.fit_sources(s.frames), s.skew)
    return counts.unionAll(
        outcome.unpivot([], ["merged", "order_master", "order_master_rejects"], "table", "rows")
    )


@query
def committed_state_summary(spark, sf_dir):
    """The state summary as a reader of committed tables finds it, past a run that failed."""
    root = f"{staged_folder(spark)}/tables-{uuid.uuid4().hex}"
    summary = shop(spark, sf_dir).state_summary()
    versions.publish(spark, root, {"state_summary": summary})
    current = versions.Versions(spark, root)
    try:
        with current.replacing(("state_summary", "sales_summary")) as path:
            summary.limit(1).write.parquet(f"{path}/state_summary")  # and no sales summary
    except LookupError:
        pass
    return current.read("state_summary")


# Missing-value rules


@query
def null_key_groups(spark, sf_dir):
    """Master rows that enter each summary, and those a missing group key keeps out."""
    s = shop(spark, sf_dir)

    def rows_with(keys):
        return F.coalesce(F.sum(F.when(all_present(keys), F.col("rows"))), F.lit(0))

    by_product = s.product_facts().agg(rows_with(["product_id"]))
    kept = s.order_facts(*facts.CUSTOMER_KEYS).agg(
        F.sum("rows").alias("all_rows"),
        rows_with(SUMMARY_KEYS["sales_summary"]).alias("sales_summary"),
        rows_with(SUMMARY_KEYS["state_summary"]).alias("state_summary"),
    )
    summaries_of_rows = ["sales_summary", "state_summary", "product_summary"]
    dropped = F.col("all_rows") - F.col("kept_rows")
    return (
        kept.withColumn("product_summary", by_product.scalar())
        .unpivot(["all_rows"], summaries_of_rows, "summary", "kept_rows")
        .select("summary", "kept_rows", dropped.alias("dropped_rows"))
    )


@query
def all_null_sum(spark, sf_dir):
    """Per order status: a sum over only missing values is 0, a mean is missing."""
    orders = marts.with_delivery_days(shop(spark, sf_dir).frames["orders"])
    days = F.sum("delivery_days")
    return orders.groupBy("order_status").agg(
        F.count("delivery_days").alias("delivered"),
        F.coalesce(days, F.lit(0)).alias("sum_days"),
        exact_ratio(days, F.count("delivery_days"), "decimal(10,2)").alias("mean_days"),
    )


# Lookups


@query
def customers_page(spark, sf_dir):
    return lookup.list_customers(shop(spark, sf_dir).sources["customers"], 50, 200).with_count()


@query
def products_page(spark, sf_dir):
    """A page from the middle of the product summary, written with an index of its files."""
    summary = marts.product_summary(shop(spark, sf_dir).product_facts())
    path = f"{staged_folder(spark)}/paged-{uuid.uuid4().hex}"
    written = pages.PagedTable.write(summary, SUMMARY_KEYS["product_summary"], path)
    return written.page(40, 90).withColumn("total", F.lit(written.count()))


@query
def master_of_order(spark, sf_dir):
    """The loaded rows of one order, looked up in a written master table."""
    loaded = load.accepted(text_shop(spark, sf_dir).loaded())
    path = f"{staged_folder(spark)}/skipping-{uuid.uuid4().hex}"
    written = skipping.write_skipping(stage(loaded, "loaded"), LOOKUP_COLUMNS, path)
    return written.filter(F.col("order_id") == "7")


@query
def customers_by_state(spark, sf_dir):
    sources = shop(spark, sf_dir).sources
    return lookup.customers_by_state(sources["customers"], "nation_7").with_count()


@query
def orders_by_status(spark, sf_dir):
    return lookup.list_orders(shop(spark, sf_dir).sources["orders"], "F", 100).with_count()


@query
def items_by_order(spark, sf_dir):
    return lookup.list_order_items(shop(spark, sf_dir).sources["order_items"], "7").with_count()


@query
def payments_by_type(spark, sf_dir):
    return lookup.list_payments(shop(spark, sf_dir).sources["payments"], "voucher").with_count()


@query
def customer_orders(spark, sf_dir):
    return lookup.customer_orders(shop(spark, sf_dir).sources["orders"], "70").with_count()


@query
def records_json(spark, sf_dir):
    return json_records(shop(spark, sf_dir).sources["customers"])


# Statistics


@query
def stats_summary(spark, sf_dir):
    return stats.summary(shop(spark, sf_dir).sources)


@query
def stats_counts(spark, sf_dir):
    return stats.source_totals(shop(spark, sf_dir).sources)


@query
def stats_revenue(spark, sf_dir):
    return stats.revenue(shop(spark, sf_dir).sources["payments"])


@query
def revenue_of_fine_amounts(spark, sf_dir):
    """Payments read as texts of six decimals: summed as they are, rounded once."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    amount = price.cast("decimal(12,2)") * discount.cast("decimal(6,4)")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return stats.revenue(lines.select(amount.cast("string").alias("payment_value")))


@query
def order_status_breakdown(spark, sf_dir):
    return stats.order_status_breakdown(shop(spark, sf_dir).sources["orders"])


@query
def top_states(spark, sf_dir):
    return stats.top_states(shop(spark, sf_dir).sources["customers"])


# SQL over the outputs


@query
def sql_master_count(spark, sf_dir):
    loaded = text_shop(spark, sf_dir).loaded()
    catalog.register({"query_order_master": load.accepted(loaded)})
    return catalog.master_count(spark, "query_order_master")


@query
def sql_state_head(spark, sf_dir):
    catalog.register({"query_state_summary": shop(spark, sf_dir).state_summary()})
    return catalog.state_head(spark, "query_state_summary")


@query
def sql_city_collated(spark, sf_dir):
    """Orders and spending of one city, matched without regard to case and accents."""
    master = shop(spark, sf_dir).master()
    city = master.filter(same_text(F.col("customer_city"), "nàtion_7-Machinery "))
    value = cents(F.col("payment_value"), city.schema["payment_value"].dataType)
    return city.groupBy("customer_city").agg(
        F.count("*").alias("master_rows"), money(F.sum(value)).alias("payment_total")
    )
