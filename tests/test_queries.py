"""Every query against its SQL, at two scales."""

import compare
import pytest

import __spark_entry__ as entry_points
from cartloom.operators.skew import SkewProfile
from cartloom.oracle import ORACLE_SQL
from cartloom.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connections():
    return {sf: compare.connect(sf) for sf in (SMALL, MEDIUM)}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL) and set(SQL) <= set(entry_points.queries())


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, connections, name, sf_dir):
    got = compare.spark_rows(entry_points.queries()[name](spark, sf_dir))
    assert got == compare.duck_rows(connections[sf_dir], SQL[name])


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "customer_state"
    assert df.count() == 25


JOINING = [
    "order_customer",
    "order_item_join",
    "master_table",
    "load_master",
    "master_rejects",
    "sales_summary",
    "delivery_summary",
    "product_summary",
    "state_summary",
    "null_key_groups",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_matches_sql_with_most_keys_split(spark, connections, monkeypatch, name):
    monkeypatch.setattr(SkewProfile.__init__, "__defaults__", (3,))
    got = compare.spark_rows(entry_points.queries()[name](spark, SMALL))
    assert got == compare.duck_rows(connections[SMALL], SQL[name])


ORDERED = {
    "customers_page": "customer_id NULLS FIRST, customer_state NULLS FIRST, customer_city NULLS FIRST, customer_zip_code_prefix",
    "order_status_breakdown": '"count" DESC, order_status',
    "top_states": '"count" DESC, customer_state',
}


@pytest.mark.parametrize("name", ORDERED)
def test_order_of_rows(spark, connections, name):
    df = entry_points.queries()[name](spark, MEDIUM)
    columns = df.columns
    names = ", ".join(f'"{c}"' for c in columns)
    result = connections[MEDIUM].execute(f"SELECT {names} FROM ({SQL[name]}) ORDER BY {ORDERED[name]}")
    want = [tuple(map(str, r)) for r in result.fetchall()]
    assert [tuple(map(str, r)) for r in df.collect()] == want
