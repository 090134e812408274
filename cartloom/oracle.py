"""ANSI SQL for every query, over the raw star-schema tables, for checking results.

Written from the definitions, not from the DataFrame code: summaries here always go
through the joined rows.
"""

# The four sources with typed columns.
TYPED = """
customers AS (
  SELECT CASE WHEN c_acctbal < -900 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN c_acctbal BETWEEN -900 AND -850 THEN NULL ELSE n_name END AS customer_state,
         CASE WHEN c_acctbal BETWEEN -849 AND -800 THEN NULL
              ELSE n_name || '-' || c_mktsegment END AS customer_city,
         lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS customer_zip_code_prefix
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
shop_orders AS (
  SELECT CASE WHEN o_totalprice < 1500 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_totalprice BETWEEN 1500 AND 2500 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         o_orderstatus AS order_status,
         o_orderdate + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR
           AS order_purchase_timestamp,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE o_orderdate + CAST((o_orderkey * 37) % 720 - 24 AS INT) * INTERVAL '1' HOUR
         END AS order_delivered_customer_date
  FROM orders
),
order_items AS (
  SELECT CASE WHEN l_extendedprice < 1000 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END
           AS order_id,
         CASE WHEN l_discount < 0.005 AND l_tax < 0.005 THEN NULL
              ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         CASE WHEN l_discount > 0.095 AND l_tax > 0.075 THEN NULL
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS price,
         CASE WHEN l_quantity > 49.5 AND l_tax > 0.075 THEN NULL
              ELSE CAST(l_quantity AS DECIMAL(12,2)) END AS freight_value
  FROM lineitem
),
payments AS (
  SELECT CASE WHEN o_totalprice > 490000 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END
           AS order_id,
         o_orderpriority AS payment_type,
         CASE WHEN o_totalprice BETWEEN 480000 AND 482000 THEN NULL
              ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS payment_value
  FROM orders
  UNION ALL
  SELECT CASE WHEN o_totalprice > 490000 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END,
         'voucher', CAST(1.25 AS DECIMAL(12,2))
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
)
"""

# The same as raw texts, and what is left of them once NA texts are NULL.
TEXT = (
    TYPED
    + """,
raw_customers AS (
  SELECT coalesce(customer_id, 'NA') AS customer_id,
         coalesce(customer_state, 'null') AS customer_state,
         coalesce(customer_city, '') AS customer_city, customer_zip_code_prefix
  FROM customers
),
raw_orders AS (
  SELECT CASE WHEN hour(order_purchase_timestamp) = 23 AND day(order_purchase_timestamp) = 1
              THEN rpad(order_id, 60, 'x') ELSE coalesce(order_id, 'None') END AS order_id,
         coalesce(customer_id, 'NULL') AS customer_id, order_status,
         strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
         CASE WHEN hour(order_purchase_timestamp) = 22 AND day(order_purchase_timestamp) = 1
              THEN 'soon'
              ELSE coalesce(strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S'), '')
         END AS order_delivered_customer_date
  FROM shop_orders
),
raw_items AS (
  SELECT coalesce(order_id, '<NA>') AS order_id, coalesce(product_id, 'n/a') AS product_id,
         CASE WHEN freight_value = 49 AND price IS NOT NULL THEN 'x'
              WHEN freight_value = 48 AND product_id IS NULL THEN '99999999999.00'
              ELSE coalesce(CAST(price AS VARCHAR), 'NaN') END AS price,
         coalesce(CAST(freight_value AS VARCHAR), 'nan') AS freight_value
  FROM order_items
),
raw_payments AS (
  SELECT coalesce(order_id, '') AS order_id, payment_type,
         coalesce(CAST(payment_value AS VARCHAR), 'N/A') AS payment_value
  FROM payments
),
t_customers AS (
  SELECT nullif(customer_id, 'NA') AS customer_id, nullif(customer_state, 'null') AS customer_state,
         nullif(customer_city, '') AS customer_city, customer_zip_code_prefix
  FROM raw_customers
),
t_orders AS (
  SELECT nullif(order_id, 'None') AS order_id, nullif(customer_id, 'NULL') AS customer_id,
         order_status, order_purchase_timestamp,
         nullif(order_delivered_customer_date, '') AS order_delivered_customer_date
  FROM raw_orders
),
t_items AS (
  SELECT nullif(order_id, '<NA>') AS order_id, nullif(product_id, 'n/a') AS product_id,
         nullif(price, 'NaN') AS price, nullif(freight_value, 'nan') AS freight_value
  FROM raw_items
),
t_payments AS (
  SELECT nullif(order_id, '') AS order_id, payment_type,
         nullif(payment_value, 'N/A') AS payment_value
  FROM raw_payments
)
"""
)


def _master(customers, orders, items, payments):
    return f"""
ok_customers AS (SELECT * FROM {customers} WHERE customer_id IS NOT NULL),
ok_orders AS (SELECT * FROM {orders} WHERE order_id IS NOT NULL AND customer_id IS NOT NULL),
ok_items AS (SELECT * FROM {items} WHERE order_id IS NOT NULL),
ok_payments AS (SELECT * FROM {payments} WHERE order_id IS NOT NULL),
with_customer AS (
  SELECT o.*, c.customer_state, c.customer_city, c.customer_zip_code_prefix
  FROM ok_orders o LEFT JOIN ok_customers c ON o.customer_id = c.customer_id
),
with_item AS (
  SELECT o.*, i.product_id, i.price, i.freight_value
  FROM with_customer o LEFT JOIN ok_items i ON o.order_id = i.order_id
),
merged AS (
  SELECT o.*, p.payment_type, p.payment_value
  FROM with_item o LEFT JOIN ok_payments p ON o.order_id = p.order_id
)
"""


MASTER = TYPED + "," + _master("customers", "shop_orders", "order_items", "payments")
TEXT_MASTER = TEXT + "," + _master("t_customers", "t_orders", "t_items", "t_payments")

_LIMITS = {
    "order_id": 50,
    "customer_id": 50,
    "customer_city": 100,
    "customer_state": 10,
    "customer_zip_code_prefix": 20,
    "order_status": 50,
    "order_purchase_timestamp": "TIMESTAMP",
    "order_delivered_customer_date": "TIMESTAMP",
    "price": "DECIMAL(12,2)",
    "freight_value": "DECIMAL(12,2)",
    "payment_type": 50,
    "payment_value": "DECIMAL(12,2)",
    "product_id": 50,
}


def _reason():
    cases = []
    for name, limit in _LIMITS.items():
        if limit == "TIMESTAMP":
            cases.append(
                f"WHEN {name} IS NOT NULL AND TRY_CAST({name} AS TIMESTAMP) IS NULL "
                f"THEN '{name}: not a timestamp'"
            )
        elif isinstance(limit, str):
            cases.append(
                f"WHEN abs(coalesce(TRY_CAST({name} AS DOUBLE), 0)) >= 9999999999.995 "
                f"THEN '{name}: out of range'"
            )
        else:
            cases.append(f"WHEN length({name}) > {limit} THEN '{name}: longer than {limit}'")
    return "CASE " + " ".join(cases) + " END"


def _loaded_columns():
    columns = []
    for name, limit in _LIMITS.items():
        if limit == "TIMESTAMP":
            columns.append(f"TRY_CAST({name} AS TIMESTAMP) AS {name}")
        elif isinstance(limit, str):
            number = f"coalesce(TRY_CAST({name} AS DOUBLE), 0)"
            columns.append(f"CAST({number} AS {limit}) AS {name}")
        else:
            columns.append(name)
    return ", ".join(columns)


def _mean(column):
    """Exact mean of non-negative amounts in cents, rounded half up."""
    total, n = f"CAST(sum({column}) * 100 AS HUGEINT)", f"count({column})"
    return f"CAST(((2 * {total} + {n}) // (2 * {n})) * 0.01 AS DECIMAL(28,2))"


def _total(column):
    return f"CAST(coalesce(sum({column}), 0) AS DECIMAL(28,2))"


_DAYS = (
    "CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp))"
    " / 86400000000.0) AS INT)"
)

_STATE = f"""
SELECT customer_state, count(DISTINCT customer_id) AS total_customers,
       count(DISTINCT order_id) AS total_orders, {_total("payment_value")} AS total_revenue,
       {_mean("payment_value")} AS avg_order_value, count(order_id) AS total_items
FROM merged WHERE customer_state IS NOT NULL GROUP BY customer_state
"""

_SALES = f"""
SELECT customer_id, customer_state, customer_city, {_total("payment_value")} AS total_spent,
       count(DISTINCT order_id) AS total_orders, count(order_id) AS total_items,
       coalesce({_mean("payment_value")}, 0) AS avg_order_value,
       coalesce({_mean("price")}, 0) AS avg_price,
       coalesce({_mean("freight_value")}, 0) AS avg_freight
FROM merged
WHERE customer_id IS NOT NULL AND customer_state IS NOT NULL AND customer_city IS NOT NULL
GROUP BY customer_id, customer_state, customer_city
"""

_PRODUCT = f"""
SELECT product_id, count(DISTINCT order_id) AS total_orders, count(order_id) AS total_items_sold,
       {_total("price")} AS total_revenue, {_mean("price")} AS avg_price,
       {_total("freight_value")} AS total_freight, {_mean("freight_value")} AS avg_freight
FROM merged WHERE product_id IS NOT NULL GROUP BY product_id
"""


def _exact(numerator, denominator, result):
    """Hundredths of a non-negative ratio of integers, rounded half up."""
    return (
        f"CAST(((2 * CAST({numerator} AS HUGEINT) * 100 + {denominator}) // (2 * {denominator}))"
        f" * 0.01 AS {result})"
    )


_DELIVERY = f"""
SELECT customer_state, count(order_id) AS total_orders, count(delivery_days) AS delivered_orders,
       {_exact("count(delivery_days) * 100", "count(order_id)", "DECIMAL(5,2)")} AS delivery_rate,
       {_exact("sum(delivery_days)", "count(delivery_days)", "DECIMAL(10,2)")} AS avg_delivery_days,
       CAST(median(delivery_days) AS DECIMAL(10,2)) AS median_delivery_days,
       min(delivery_days) AS fastest_delivery, max(delivery_days) AS slowest_delivery,
       CAST(stddev_samp(delivery_days) AS DECIMAL(10,2)) AS std_delivery_days
FROM (SELECT *, {_DAYS} AS delivery_days FROM with_customer)
WHERE customer_state IS NOT NULL GROUP BY customer_state
"""

_FANOUT = """
SELECT customer_state, count(*) AS master_rows, count(payment_value) AS payments,
       CAST(sum(payment_value) AS DECIMAL(28,2)) AS payment_total, count(price) AS prices,
       CAST(sum(price) AS DECIMAL(28,2)) AS price_total
FROM merged WHERE customer_state IS NOT NULL GROUP BY customer_state
"""


def _counts(**tables):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS \"rows\" FROM {source}"
        for name, source in tables.items()
    )


_SOURCE_NAMES = {
    "customers": "customers",
    "orders": "shop_orders",
    "order_items": "order_items",
    "payments": "payments",
}

_KEPT = {
    "customers": "customer_id IS NOT NULL",
    "orders": "order_id IS NOT NULL AND customer_id IS NOT NULL",
    "order_items": "order_id IS NOT NULL",
    "payments": "order_id IS NOT NULL",
}

_NULL_KEYS = {
    "sales_summary": _SALES.split("WHERE")[1].split("GROUP BY")[0].strip(),
    "product_summary": "product_id IS NOT NULL",
    "state_summary": "customer_state IS NOT NULL",
}


def _page(source, keys, limit, offset=0, where="TRUE", count="total"):
    order = ", ".join(f"{k} ASC NULLS FIRST" for k in keys)
    return (
        f"SELECT *, (SELECT count(*) FROM {source} WHERE {where}) AS {count} FROM {source} "
        f"WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset}"
    )


def _all(source, where, count):
    return (
        f"SELECT *, (SELECT count(*) FROM {source} WHERE {where}) AS {count} "
        f"FROM {source} WHERE {where}"
    )


_CUSTOMER_ORDER = ["customer_id", "customer_state", "customer_city", "customer_zip_code_prefix"]
_ORDERS_ORDER = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
]
_ITEMS_ORDER = ["order_id", "product_id", "price", "freight_value"]
_PAYMENTS_ORDER = ["order_id", "payment_type", "payment_value"]

_AVERAGE_PAYMENT = (
    "CAST(((2 * CAST(sum(payment_value) * 100 AS HUGEINT) * 10000 + count(payment_value))"
    " // (2 * count(payment_value))) * 0.000001 AS DECIMAL(28,6))"
)

_STATUS_COUNTS = """
SELECT order_status, count(*) AS "count" FROM shop_orders WHERE order_status IS NOT NULL
GROUP BY order_status
"""
_STATE_COUNTS = """
SELECT customer_state, count(*) AS "count" FROM customers WHERE customer_state IS NOT NULL
GROUP BY customer_state ORDER BY "count" DESC, customer_state LIMIT 10
"""


def _metric(metric, key, value, source):
    return (
        f"SELECT '{metric}' AS metric, {key} AS \"key\", CAST({value} AS DECIMAL(28,6)) AS value "
        f"FROM {source}"
    )


def _with(ctes, body):
    return f"WITH {ctes.strip()}\n{body.strip()}"


ORACLE_SQL = {
    "scan_counts": _with(TYPED, _counts(**_SOURCE_NAMES)),
    "na_normalise": _with(TEXT, "SELECT * FROM t_customers"),
    "na_normalise_orders": _with(TEXT, "SELECT * FROM t_orders"),
    "na_normalise_order_items": _with(TEXT, "SELECT * FROM t_items"),
    "na_normalise_payments": _with(TEXT, "SELECT * FROM t_payments"),
    "clean_counts": _with(
        TYPED,
        " UNION ALL ".join(
            f"SELECT '{name}' AS \"table\", count(*) AS \"rows\", "
            f"count(CASE WHEN {_KEPT[name]} THEN 1 END) AS kept FROM {source}"
            for name, source in _SOURCE_NAMES.items()
        ),
    ),
    "data_loaded": _with(
        TYPED,
        " UNION ALL ".join(
            f"SELECT '{name}' AS source, count(*) > 0 AS loaded FROM {source}"
            for name, source in _SOURCE_NAMES.items()
        ),
    ),
    "order_customer": _with(MASTER, "SELECT * FROM with_customer"),
    "order_item_join": _with(MASTER, "SELECT * FROM with_item"),
    "master_table": _with(MASTER, "SELECT * FROM merged"),
    "load_master": _with(
        TEXT_MASTER, f"SELECT {_loaded_columns()} FROM merged WHERE {_reason()} IS NULL"
    ),
    "master_of_order": _with(
        TEXT_MASTER,
        f"SELECT * FROM (SELECT {_loaded_columns()} FROM merged WHERE {_reason()} IS NULL) WHERE order_id = '7'",
    ),
    "master_rejects": _with(
        TEXT_MASTER,
        f"SELECT {_reason()} AS reject_reason, {', '.join(_LIMITS)} FROM merged "
        f"WHERE {_reason()} IS NOT NULL",
    ),
    "reject_samples": _with(
        TEXT_MASTER,
        f"""SELECT *, row_number() OVER (PARTITION BY reject_reason ORDER BY row_hash,
          {', '.join(f'{c} NULLS FIRST' for c in _LIMITS)}) AS rank FROM (
          SELECT {_reason()} AS reject_reason, {', '.join(_LIMITS)},
            md5(concat_ws('|', {', '.join(f"coalesce({c}, '')" for c in _LIMITS)})) AS row_hash
          FROM merged WHERE {_reason()} IS NOT NULL) QUALIFY rank <= 5""",
    ),
    "delivery_days": _with(
        TEXT_MASTER,
        f"""SELECT order_id, customer_id, {_DAYS} AS delivery_days FROM (
        SELECT order_id, customer_id,
               TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
               TRY_CAST(order_delivered_customer_date AS TIMESTAMP)
                 AS order_delivered_customer_date
        FROM ok_orders)""",
    ),
    "sales_summary": _with(MASTER, _SALES),
    "delivery_summary": _with(MASTER, _DELIVERY),
    "product_summary": _with(MASTER, _PRODUCT),
    "state_summary": _with(MASTER, _STATE),
    "state_summary_of_master": _with(MASTER, _STATE),
    "committed_state_summary": _with(MASTER, _STATE),
    "products_page": _with(MASTER, _page(f"({_PRODUCT})", ["product_id"], 40, 90)),
    "sales_summary_of_master": _with(MASTER, _SALES),
    "fanout_preagg": _with(MASTER, _FANOUT),
    "fanout_rows": _with(MASTER, _FANOUT),
    "summary_row_ids": _with(
        MASTER,
        f"SELECT row_number() OVER (ORDER BY product_id) AS id, product_id, total_orders "
        f"FROM ({_PRODUCT})",
    ),
    "run_row_counts": _with(
        TEXT_MASTER,
        _counts(
            **{name: f"t_{name}" for name in ("customers", "orders")},
            order_items="t_items",
            payments="t_payments",
            merged="merged",
            order_master=f"(SELECT * FROM merged WHERE {_reason()} IS NULL)",
            order_master_rejects=f"(SELECT * FROM merged WHERE {_reason()} IS NOT NULL)",
            sales_summary=f"""(SELECT DISTINCT customer_id, customer_state, customer_city
              FROM merged WHERE {_NULL_KEYS["sales_summary"]})""",
            delivery_summary="""(SELECT DISTINCT customer_state FROM with_customer
              WHERE customer_state IS NOT NULL)""",
            product_summary=f"""(SELECT DISTINCT product_id FROM merged
              WHERE {_NULL_KEYS["product_summary"]})""",
            state_summary=f"""(SELECT DISTINCT customer_state FROM merged
              WHERE {_NULL_KEYS["state_summary"]})""",
        ),
    ),
    "null_key_groups": _with(
        MASTER,
        " UNION ALL ".join(
            f"SELECT '{name}' AS summary, count(CASE WHEN {keys} THEN 1 END) AS kept_rows, "
            f"count(CASE WHEN NOT ({keys}) THEN 1 END) AS dropped_rows FROM merged"
            for name, keys in _NULL_KEYS.items()
        ),
    ),
    "all_null_sum": _with(
        MASTER,
        f"""SELECT order_status, count(delivery_days) AS delivered,
        CAST(coalesce(sum(delivery_days), 0) AS BIGINT) AS sum_days,
        {_exact("sum(delivery_days)", "count(delivery_days)", "DECIMAL(10,2)")} AS mean_days
        FROM (SELECT *, {_DAYS} AS delivery_days FROM ok_orders) GROUP BY order_status""",
    ),
    "customers_page": _with(TYPED, _page("customers", _CUSTOMER_ORDER, 50, 200)),
    "customers_by_state": _with(TYPED, _all("customers", "customer_state = 'NATION_7'", "count")),
    "orders_by_status": _with(
        TYPED, _page("shop_orders", _ORDERS_ORDER, 100, where="order_status = 'F'")
    ),
    "items_by_order": _with(TYPED, _page("order_items", _ITEMS_ORDER, 100, where="order_id = '7'")),
    "payments_by_type": _with(
        TYPED, _page("payments", _PAYMENTS_ORDER, 100, where="payment_type = 'voucher'")
    ),
    "customer_orders": _with(TYPED, _all("shop_orders", "customer_id = '70'", "order_count")),
    "records_json": _with(
        TYPED,
        """SELECT CAST(to_json({'customer_id': customer_id, 'customer_state': customer_state,
        'customer_city': customer_city, 'customer_zip_code_prefix': customer_zip_code_prefix})
        AS VARCHAR) AS record FROM customers""",
    ),
    "stats_summary": _with(
        TYPED,
        " UNION ALL ".join(
            [
                _metric(f"total_{name}", "NULL", "count(*)", source)
                for name, source in _SOURCE_NAMES.items()
            ]
            + [
                _metric("order_status_breakdown", "order_status", '"count"', f"({_STATUS_COUNTS})"),
                _metric("total_revenue", "NULL", "sum(payment_value)", "payments"),
                _metric("average_payment", "NULL", _AVERAGE_PAYMENT, "payments"),
                _metric("customers_by_state", "customer_state", '"count"', f"({_STATE_COUNTS})"),
            ]
        ),
    ),
    "stats_counts": _with(
        TYPED,
        "SELECT "
        + ", ".join(
            f"(SELECT count(*) FROM {source}) AS total_{name}"
            for name, source in _SOURCE_NAMES.items()
        ),
    ),
    "revenue_of_fine_amounts": _with(
        TYPED,
        """SELECT CAST(sum(v) AS DECIMAL(28,2)) AS total_revenue,
        CAST(CAST(sum(v) AS DECIMAL(38,12)) / count(v) AS DECIMAL(28,6)) AS average_payment
        FROM (SELECT CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(6,4))
          AS v FROM lineitem)""",
    ),
    "stats_revenue": _with(
        TYPED,
        f"SELECT {_total('payment_value')} AS total_revenue, {_AVERAGE_PAYMENT} AS average_payment "
        "FROM payments",
    ),
    "order_status_breakdown": _with(TYPED, _STATUS_COUNTS),
    "top_states": _with(TYPED, _STATE_COUNTS),
    "sql_master_count": _with(
        TEXT_MASTER, f"SELECT count(*) AS n FROM merged WHERE {_reason()} IS NULL"
    ),
    "sql_state_head": _with(MASTER, f"SELECT * FROM ({_STATE}) ORDER BY customer_state LIMIT 5"),
    "sql_city_collated": _with(
        MASTER,
        """SELECT customer_city, count(*) AS master_rows,
        CAST(sum(payment_value) AS DECIMAL(28,2)) AS payment_total FROM merged
        WHERE rtrim(strip_accents(lower(customer_city)))
              = rtrim(strip_accents(lower('nàtion_7-Machinery ')))
        GROUP BY customer_city""",
    ),
}
