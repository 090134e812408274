"""Joins with hot keys give the same rows as plain joins."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from shops import prepared, sources

from cartloom.operators import facts, joins, marts
from cartloom.operators.skew import SkewProfile, spread


def shop_rows(seed, hot):
    rng = random.Random(seed)
    rows = {"customers": [], "orders": [], "order_items": [], "payments": []}
    for c in range(12):
        for _ in range(rng.choice([1, 1, 2])):
            rows["customers"].append((f"c{c}", rng.choice(["AA", "BB", None]), f"city{c % 5}"))
    for o in range(40):
        for _ in range(rng.choice([1, 1, 1, 2])):
            rows["orders"].append((f"o{o}", f"c{rng.randrange(15)}", "new"))
        for _ in range(rng.randrange(4)):
            rows["order_items"].append((f"o{o}", f"p{rng.randrange(6)}", "2.50", "0.75"))
        for _ in range(rng.randrange(3)):
            rows["payments"].append((f"o{o}", "card", str(rng.randrange(900) / 100)))
    key = {"customers": "c1", "orders": "o1", "order_items": "o1", "payments": "o1"}
    for name in hot:
        row = {
            "customers": ("c1", "AA", "city1"),
            "orders": ("o1", "c1", "new"),
            "order_items": ("o1", "p1", "1.00", "0.10"),
            "payments": ("o1", "card", "3.00"),
        }[name]
        assert row[0] == key[name]
        rows[name] += [row] * 37  # identical copies of one row
        rows[name] += [(r[0], *row[1:]) for r in rows[name][:5]]
    return rows


def multiset(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


HOT = [
    [],
    ["order_items"],
    ["payments"],
    ["order_items", "payments"],
    ["orders"],
    ["orders", "order_items", "payments"],
    ["customers"],
    ["customers", "orders", "order_items"],
]


@pytest.mark.parametrize("hot", HOT, ids="+".join)
def test_split_joins_equal_plain_joins(spark, hot):
    frames = sources(spark, **shop_rows(len(hot), hot))
    clean, plain = prepared(frames)
    _, split = prepared(frames, cell_rows=2)
    if hot:
        assert split.hot("order_id", "orders", "order_items", "payments").tables

    for build in (joins.order_customer, joins.order_item_join, joins.master_table):
        assert multiset(build(clean, split)) == multiset(build(clean, plain))

    master = joins.master_table(clean, plain)
    by_row = facts.facts_of_master(master)
    per_order = facts.one_per_order(by_row, facts.CUSTOMER_KEYS)
    sales = multiset(marts.sales_summary(facts.totals_per_key(per_order, facts.CUSTOMER_KEYS)))
    per_order = facts.one_per_order(by_row, ["customer_state"])
    states = multiset(marts.state_summary(per_order, facts.buyers_of_master(master)))
    products = multiset(marts.product_summary(by_row))
    for skew in (plain, split):
        customer_facts = facts.order_facts(clean, skew, ["customer_id"])
        totals = facts.customer_totals(customer_facts, clean)
        assert multiset(marts.sales_summary(totals)) == sales
        for state_facts in (
            facts.order_facts(clean, skew, ["customer_state"]),
            facts.state_facts(customer_facts, clean),
        ):
            assert multiset(marts.state_summary(state_facts, facts.buyers(clean))) == states
        assert multiset(marts.product_summary(facts.product_facts(clean, skew))) == products


def test_rows_of_a_hot_key_are_dealt_evenly(spark):
    frames = sources(
        spark,
        orders=[("o1", "c1"), ("o2", "c1")],
        order_items=[("o1", "p", "1", "1")] * 100 + [("o2", "p", "1", "1")],
    )
    clean, skew = prepared(frames, cell_rows=10)
    hot = skew.hot("order_id", "orders", "order_items")
    assert [tuple(r) for r in hot.fans.collect()] == [("o1", 1, 10)]
    cells = spread(clean["order_items"], "order_items", hot).groupBy("order_id", *hot.salts())
    sizes = {(r[0], r[2]): r[3] for r in cells.count().collect()}
    assert sizes.pop(("o2", 0)) == 1
    assert len(sizes) == 10 and sum(sizes.values()) == 100 and max(sizes.values()) <= 20


def test_rows_from_files_are_dealt_alike_every_time(spark, tmp_path):
    frames = sources(
        spark, orders=[("o1", "c1")] * 3, order_items=[("o1", f"p{i}", "1", "1") for i in range(90)]
    )
    path = str(tmp_path / "items")
    frames["order_items"].repartition(4).write.parquet(path)
    frames["order_items"] = spark.read.parquet(path)
    clean, skew = prepared(frames, cell_rows=10)
    hot = skew.hot("order_id", "orders", "order_items")
    dealt = [multiset(spread(clean["order_items"], "order_items", hot)) for _ in range(2)]
    assert dealt[0] == dealt[1] and sum(dealt[0].values()) == 90


def test_small_tables_are_not_searched(spark):
    frames = sources(spark, orders=[("o1", "c1")] * 5)
    clean, _ = prepared(frames)
    skew = SkewProfile(frames, clean, cell_rows=5)
    assert skew.hot("order_id", "orders").fans is None
    assert skew.hot("order_id", "orders").tables == ()


def cells(clean, hot):
    """Joined rows of each cell."""
    sides = [
        spread(clean[t], t, hot).groupBy("order_id", *hot.salts()).agg(F.count("*").alias(t))
        for t in ("order_items", "payments")
    ]
    both = sides[0].join(sides[1], ["order_id", *hot.salts()])
    return [r[0] for r in both.select(F.col("order_items") * F.col("payments")).collect()]


@pytest.mark.parametrize("layout", ["in a row", "every second line", "one per file", "long id"])
def test_no_cell_makes_many_more_rows_than_asked(spark, tmp_path, layout):
    """100 items x 100 payments of one order, 400 rows asked for: 25 cells of 400 on average."""
    key = "o" * 120 if layout == "long id" else "o1"
    gap = layout in ("every second line", "one per file")
    rows = [r for i in range(100) for r in [(key, "p", "1", "1"), (f"x{i}", "p", "1", "1")][: 1 + gap]]
    frames = sources(
        spark,
        customers=[("c1", "AA", "x")],
        orders=[(key, "c1")],
        order_items=rows,
        payments=[(o, "card", "1") for o, *_ in rows],
    )
    for name in ("order_items", "payments"):
        path = str(tmp_path / name)
        if layout == "one per file":
            for n in range(0, 200, 2):
                part = frames[name].limit(0).union(spark.createDataFrame([((*r, *[None] * 9)[: len(frames[name].columns)]) for r in (rows if name == "order_items" else [(o, "card", "1") for o, *_ in rows])[n : n + 2]], frames[name].schema))
                part.coalesce(1).write.mode("append").parquet(path)
                if n >= 38:  # 20 files are enough to show the layout
                    break
        else:
            frames[name].coalesce(4).write.parquet(path)
        frames[name] = spark.read.parquet(path)
    clean, skew = prepared(frames, cell_rows=16 if layout == "one per file" else 400)
    n = 20 if layout == "one per file" else 100
    hot = skew.hot("order_id", "orders", "order_items", "payments")
    assert [tuple(r)[1:] for r in hot.fans.collect()] == [(1, 5, 5)]
    sizes = cells(clean, hot)
    assert sum(sizes) >= n * n and len(sizes) >= 16 and max(sizes) <= 4 * skew.cell_rows
    assert multiset(joins.master_table(clean, skew)) == multiset(joins.master_table(clean, prepared(frames)[1]))


def test_a_key_is_hot_by_the_product_of_its_rows(spark):
    frames = sources(
        spark,
        orders=[("o1", "c1")],
        order_items=[("o1", "p", "1", "1")] * 10,
        payments=[("o1", "card", "1")] * 10 + [(f"x{i}", "card", "1") for i in range(50)],
    )
    _, skew = prepared(frames, cell_rows=10)
    found = skew.hot("order_id", "orders", "order_items", "payments").fans.collect()
    assert [tuple(r) for r in found] == [("o1", 1, 4, 4)]
