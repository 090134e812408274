"""Lookups in tables that are laid out along a space-filling curve."""

import pytest
from pyspark.sql import functions as F

from cartloom.plans import skipping
from cartloom.plans.skipping import Ranges, curve, with_place, write_skipping

COLUMNS = ["order_id", "customer_id", "customer_state"]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.range(40_000).select(
        F.format_string("order-%07d", F.pmod(F.xxhash64("id"), F.lit(9_000_000))).alias("order_id"),
        F.format_string("customer-%06d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4_000))).alias("customer_id"),
        F.format_string("state %d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(25))).alias("customer_state"),
        F.col("id").alias("payload"),
    ).cache()


def scanned(df):
    """Rows the answer has, and rows of the row groups its scan had to read."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return found, leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def table(spark, orders, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skipping") / "t")
    return write_skipping(orders, COLUMNS, path, row_group=16 << 10)


@pytest.mark.parametrize("column", COLUMNS)
def test_lookups_read_few_row_groups(spark, orders, table, column):
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", "true")
    for value in [r[0] for r in orders.select(column).distinct().orderBy(F.xxhash64(column)).limit(4).collect()]:
        found, read = scanned(table.filter(F.col(column) == value))
        want = orders.filter(F.col(column) == value).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, want)) and want
        assert read < 0.5 * 40_000


def test_a_plain_layout_reads_more(spark, orders, table, tmp_path):
    orders.write.option("parquet.block.size", 16 << 10).parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    for column in COLUMNS:
        value = orders.select(column).orderBy(F.xxhash64(column)).first()[0]
        read = [scanned(t.filter(F.col(column) == value))[1] for t in (table, plain)]
        assert read[0] < 0.5 * read[1]


def test_absent_values_and_all_rows(table, orders):
    assert scanned(table.filter("order_id = 'order-none'"))[0] == []
    assert table.count() == 40_000 and table.exceptAll(orders).isEmpty()


def test_odd_columns(spark, tmp_path):
    rows = [(None, "a", 1), ("", None, 2), ("é" * 9, "a", 3), ("é" * 9 + "x", "a", 4), (None, None, 5)] * 3
    df = spark.createDataFrame(rows, "a string, b string, c int")
    got = write_skipping(df, ["a", "b"], str(tmp_path / "odd"))
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert got.filter("a IS NULL").count() == 6 and got.filter(F.col("a") == "").count() == 3
    none = write_skipping(df.limit(0), ["a", "b", "c"], str(tmp_path / "none"))
    assert none.isEmpty() and none.columns == ["a", "b", "c"]


def test_the_curve_keeps_neighbours_together(spark):
    df = spark.range(4096).select(F.format_string("%02d", F.col("id") % 64).alias("x"), F.format_string("%02d", F.floor(F.col("id") / 64)).alias("y"))
    places = df.select("x", "y", curve(df, ["x", "y"]).alias("p")).orderBy("p").collect()
    first = places[:900]  # most of a quarter: the lower half of both columns
    assert len({r.x for r in first}) <= 32 and len({r.y for r in first}) <= 32


def test_the_place_written_is_that_of_the_curve(spark):
    rows = [(None, "a", 1), ("", None, 2), ("é" * 9, "a", 3), ("é" * 9 + "x", "ab", 4), (None, None, 5), ("\0z", "a\0", 6)]
    rows += [(f"k{i * 37 % 101}", f"state {i % 7}", i) for i in range(400)]
    for n, columns in ((400, ["a", "b"]), (len(rows), ["a", "b", "c"])):
        df = spark.createDataFrame(rows[-n:], "a string, b string, c int")
        places = with_place(df, Ranges.of(df, columns)).withColumn("p", curve(df, columns)).collect()
        assert len({r.p for r in places}) > 50 and all(r.p == r._place for r in places)


def test_whole_rows_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        read.add(1)
        return x

    df = spark.range(3_000).select(F.format_string("k%05d", "id").alias("x"), counted("id").alias("payload"))
    written = write_skipping(df, ["x"], str(tmp_path / "once"))
    assert read.value == 3_000
    assert sorted(r.payload for r in written.collect()) == list(range(3_000))


def test_a_place_of_many_rows_is_dealt_over_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(skipping, "PART_ROWS", 500)
    df = spark.range(6_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.format_string("k%05d", "id")).alias("x"), "id")
    written = write_skipping(df, ["x"], str(tmp_path / "hot"))
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 6_000 and max(sizes) < 1_500 and written.exceptAll(df).isEmpty()
    assert written.filter("x = 'hot'").count() == 4_000
