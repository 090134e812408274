"""Small hand-made sources."""

from pyspark.sql import SparkSession

from cartloom.operators.clean import clean
from cartloom.operators.skew import SkewProfile

SCHEMAS = {
    "customers": "customer_id string, customer_state string, customer_city string, "
    "customer_zip_code_prefix string",
    "orders": "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp string, order_delivered_customer_date string",
    "order_items": "order_id string, product_id string, price string, freight_value string",
    "payments": "order_id string, payment_type string, payment_value string",
}


def sources(spark: SparkSession, **rows):
    """Frames of text columns; rows may be shorter than the schema, missing ends are NULL."""
    frames = {}
    for name, schema in SCHEMAS.items():
        width = schema.count(",") + 1
        padded = [tuple(r) + (None,) * (width - len(r)) for r in rows.get(name, [])]
        frames[name] = spark.createDataFrame(padded, schema)
    return frames


def prepared(frames, cell_rows=1_000_000):
    kept = clean(frames)
    return kept, SkewProfile(frames, kept, cell_rows)


def dicts(df, *keys):
    rows = [r.asDict() for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
