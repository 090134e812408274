import pytest
from shops import sources

from cartloom.operators import lookup
from cartloom.operators.rowids import number_rows


@pytest.fixture(scope="module")
def shop(spark):
    return sources(
        spark,
        customers=[(f"c{i:02d}", "SP" if i % 2 else "rj", "x") for i in range(30)],
        orders=[(f"o{i}", f"c{i % 3:02d}", "new" if i % 2 else "done") for i in range(9)],
        order_items=[("o1", "p1", "1", "1"), ("o2", "p2", "2", "1")],
        payments=[("o1", "card", "1"), ("o2", "Card", "2"), ("o3", None, "3")],
    )


def ids(listing, column):
    return [r[column] for r in listing.rows.collect()]


def test_pages_are_cut_in_key_order(shop):
    answer = lookup.list_customers(shop["customers"], limit=3, offset=5).answer()
    assert {k: answer[k] for k in ("total", "limit", "offset")} == {
        "total": 30,
        "limit": 3,
        "offset": 5,
    }
    assert [r.customer_id for r in answer["data"].collect()] == ["c05", "c06", "c07"]
    assert len(ids(lookup.list_customers(shop["customers"]), "customer_id")) == 30


def test_page_bounds(shop):
    customers = shop["customers"]
    assert ids(lookup.list_customers(customers, 0), "customer_id") == []
    assert ids(lookup.list_customers(customers, 5, 28), "customer_id") == ["c28", "c29"]
    assert ids(lookup.list_customers(customers, 5, 99), "customer_id") == []
    for limit, offset in ((-1, 0), (1, -1)):
        with pytest.raises(ValueError):
            lookup.list_customers(customers, limit, offset)


def test_pages_of_any_depth(spark):
    rows = [(f"c{i:05d}" if i % 7 else "same", "SP" if i % 3 else None) for i in range(9000)]
    customers = sources(spark, customers=rows)["customers"].repartition(13)
    low = lambda r: tuple((x is not None, x or "") for x in r)
    ordered = sorted(((r[0], r[1], None, None) for r in rows), key=low)
    for limit, offset in ((7, 11), (5000, 3500), (3, 8998), (10, 1284), (9000, 1)):
        got = [tuple(r) for r in lookup.list_customers(customers, limit, offset).rows.collect()]
        assert got == ordered[offset : offset + limit]


def test_state_argument_is_upper_cased_but_the_column_is_not(shop):
    found = lookup.customers_by_state(shop["customers"], "sp").answer()
    assert (found["state"], found["count"]) == ("SP", 15)
    missing = lookup.customers_by_state(shop["customers"], "rj").answer()
    assert missing["message"] == "no customer lives in state rj"
    assert missing["data"].count() == 0


def test_filters_are_exact_and_optional(shop):
    payments = shop["payments"]
    assert ids(lookup.list_payments(payments, "card"), "order_id") == ["o1"]
    assert len(ids(lookup.list_payments(payments, ""), "order_id")) == 3
    assert len(ids(lookup.list_payments(payments), "order_id")) == 3
    orders = lookup.list_orders(shop["orders"], "new", limit=2).answer()
    assert orders["total"] == 4 and orders["data"].count() == 2
    items = lookup.list_order_items(shop["order_items"], "o2")
    assert ids(items, "product_id") == ["p2"]


def test_orders_of_a_customer(shop):
    found = lookup.customer_orders(shop["orders"], "c01").answer()
    assert (found["customer_id"], found["order_count"]) == ("c01", 3)
    assert "has no orders" in lookup.customer_orders(shop["orders"], "nobody").answer()["message"]


def test_empty_sources_are_refused_and_flagged(spark, shop):
    empty = sources(spark, customers=[("c1",)])
    with pytest.raises(lookup.SourceUnavailable):
        lookup.list_orders(empty["orders"])
    assert dict(lookup.data_loaded(empty).collect()) == {
        "customers": True,
        "orders": False,
        "order_items": False,
        "payments": False,
    }


def test_numbers_follow_the_keys_without_gaps(spark):
    df = spark.range(5000).selectExpr("lpad(cast((id * 7919) % 5000 as string), 4, '0') as k")
    rows = number_rows(df.repartition(6), ["k"]).collect()
    assert sorted((r.id, r.k) for r in rows) == [(i + 1, f"{i:04d}") for i in range(5000)]
    assert number_rows(df.limit(0), ["k"]).count() == 0
