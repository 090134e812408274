"""Expressions against plain Python over random values."""

from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartloom.functions.amounts import cents, mean_money
from cartloom.functions.dates import whole_days

FEW = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
MOMENT = st.datetimes(datetime(1990, 1, 1), datetime(2040, 1, 1))
SPAN = st.timedeltas(timedelta(days=-40), timedelta(days=400))


@FEW
@given(rows=st.lists(st.tuples(MOMENT, SPAN), min_size=50, max_size=200))
def test_whole_days_are_floored_timedeltas(spark, rows):
    df = spark.createDataFrame(
        [(start, start + span, span.days) for start, span in rows],
        "s timestamp_ntz, e timestamp_ntz, want int",
    )
    assert df.filter(whole_days(F.col("s"), F.col("e")) != F.col("want")).isEmpty()


@FEW
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 10**15), st.integers(1, 10**6)), min_size=50, max_size=200
    )
)
def test_means_are_exact_quotients_rounded_half_up(spark, rows):
    def want(total, count):
        exact = Decimal(total) / Decimal(count) / 100
        return exact.quantize(Decimal("0.01"), ROUND_HALF_UP)

    df = spark.createDataFrame(rows, "c long, n long")
    got = df.select("c", "n", mean_money(F.col("c"), F.col("n")).alias("m")).collect()
    assert [r.m for r in got] == [want(r.c, r.n) for r in got]


@FEW
@given(rows=st.lists(st.decimals(-(10**6), 10**6, places=2), min_size=50, max_size=200))
def test_cents_keep_two_decimals(spark, rows):
    df = spark.createDataFrame([(str(v), int(v * 100)) for v in rows], "v string, want long")
    assert df.filter(cents(F.col("v"), df.schema["v"].dataType) != F.col("want")).isEmpty()
