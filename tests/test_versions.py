"""Committed sets of tables, indexed pages, and what the plans of the new jobs hold."""

import itertools
import threading

import pytest
from pyspark.sql import functions as F
from test_plans import columns, shuffles
from test_refresh import FILES

from cartloom.operators import load, lookup
from cartloom.operators.clean import clean
from cartloom.operators.joins import master_table
from cartloom.operators.skew import SkewProfile
from cartloom.plans import refresh, versions
from cartloom.plans.pages import PagedTable
from cartloom.plans.versions import Conflict, Versions, publish
from cartloom.queries import QUERIES
from cartloom.schemas import CONTRACTS, MASTER

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


@pytest.fixture
def in_dir(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, lines in FILES.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_tables_are_replaced_together(spark, root):
    held = Versions(spark, root)
    assert held.current() is None
    with pytest.raises(LookupError):
        held.read("a")
    publish(spark, root, {"a": spark.range(3), "b": spark.range(30)})
    first = held.read("a")
    with held.replacing(("a", "b")) as path:
        spark.range(4).write.parquet(f"{path}/a")
        assert held.read("a").count() == 3 and held.read("b").count() == 30
        spark.range(40).write.parquet(f"{path}/b")
    assert held.read("a").count() == 4 and held.read("b").count() == 40
    assert first.count() == 3  # a reader who came before still reads the former run
    assert held.current().number == 2 and held.current().tables == ("a", "b")


def test_a_run_that_fails_or_lacks_a_table_changes_nothing(spark, root):
    held = Versions(spark, root)
    publish(spark, root, {"a": spark.range(3)})
    with pytest.raises(ZeroDivisionError), held.replacing(("a",)) as path:
        spark.range(4).write.parquet(f"{path}/a")
        1 / 0  # noqa: B018
    with pytest.raises(LookupError, match="b"), held.replacing(("a", "b")) as path:
        spark.range(4).write.parquet(f"{path}/a")
    assert held.read("a").count() == 3 and held.current().number == 1
    assert held.files.names(f"{root}/_runs") == [held.current().run]


def test_a_failure_between_data_and_commit(spark, root, monkeypatch):
    publish(spark, root, {"a": spark.range(3)})

    def lost(*_):
        raise OSError("the driver's connection broke")

    monkeypatch.setattr(versions.Files, "create", lost)
    with pytest.raises(OSError):
        publish(spark, root, {"a": spark.range(4)})
    assert Versions(spark, root).read("a").count() == 3


def test_of_two_runs_the_later_commit_fails(spark, root):
    held = Versions(spark, root)
    publish(spark, root, {"a": spark.range(3)})
    with pytest.raises(Conflict), held.replacing(("a",)) as path:
        publish(spark, root, {"a": spark.range(5)})
        spark.range(4).write.parquet(f"{path}/a")
    assert held.read("a").count() == 5


def test_many_runs_at_once_commit_one_at_a_time(spark, root):
    done = []

    def one(n):
        try:
            done.append(publish(spark, root, {"a": spark.range(n)}))
        except Conflict:
            done.append(None)

    threads = [threading.Thread(target=one, args=(n,)) for n in range(1, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    committed = [c for c in done if c]
    assert len(done) == 6 and committed
    held = Versions(spark, root)
    numbers = held._commits()
    assert max(numbers) >= 1 and len(numbers) <= versions.KEPT
    held.read("a").count()


def test_old_runs_go(spark, root):
    for n in range(1, 6):
        publish(spark, root, {"a": spark.range(n)})
    held = Versions(spark, root)
    assert held._commits() == [4, 5] and len(held.files.names(f"{root}/_runs")) == 2
    assert held.read("a").count() == 5


def test_a_commit_name_is_taken_once(spark, root):
    files = Versions(spark, root).files
    files.create(f"{root}/x", "one")
    with pytest.raises(FileExistsError):
        files.create(f"{root}/x", "two")
    assert files.read(f"{root}/x") == "one" and files.names(root) == ["x"] or ".x.crc" in files.names(root)


def test_a_refresh_that_fails_leaves_the_former_tables(spark, in_dir, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    refresh.run(spark, in_dir, out)
    held = Versions(spark, out)
    before = {name: sorted(map(str, held.read(name).collect())) for name in CONTRACTS}
    seen = itertools.count()
    plain = refresh.save_folder

    def breaks(*args):
        if next(seen) == 3:
            raise OSError("disk full")
        return plain(*args)

    monkeypatch.setattr(refresh, "save_folder", breaks)
    with pytest.raises(OSError):
        refresh.run(spark, in_dir, out)
    assert {name: sorted(map(str, held.read(name).collect())) for name in CONTRACTS} == before
    assert len(held.files.names(f"{out}/_runs")) == 1


def test_counts_come_from_the_writes(spark, in_dir, tmp_path):
    done = refresh.run(spark, in_dir, str(tmp_path / "out"))
    counted = dict(done.rows.collect())
    for name, table in done.tables.items():
        assert counted.get(name, 0) == table.count()


# --- counts of a run


@pytest.mark.parametrize("cell_rows", [4_000_000, 2])
def test_outcome_counts_are_those_of_the_joined_rows(spark, cell_rows):
    long_id, late = "x" * 60, "not a time"
    sources = {
        "customers": [("c1", "SP", "a", "1"), ("c1", "RJ", "b" * 200, "2"), ("c2", "SP", "a", "3"), (None, "SP", "a", "4")],
        "orders": [("o1", "c1", "s", None, None), ("o2", "c2", "s", late, None), ("o3", "c9", "s", None, None), ("o1", "c2", "s", None, None), (long_id, "c2", "s", None, None)],
        "order_items": [("o1", "p", "1", "1"), ("o1", "p", "99999999999", "1"), ("o2", "p", "1", "1"), ("o9", "p", "1", "1")] + [("o3", "p", "1", "1")] * 5,
        "payments": [("o1", "card", "1"), ("o1", "card", "99999999999"), ("o3", "card", "2"), ("o3", "y" * 300, "2")],
    }
    names = {
        "customers": "customer_id, customer_state, customer_city, customer_zip_code_prefix",
        "orders": "order_id, customer_id, order_status, order_purchase_timestamp, order_delivered_customer_date",
        "order_items": "order_id, product_id, price, freight_value",
        "payments": "order_id, payment_type, payment_value",
    }
    frames = {k: spark.createDataFrame(v, ", ".join(f"{c} string" for c in names[k].split(", "))) for k, v in sources.items()}
    frames = clean(frames)
    skew = SkewProfile(frames, frames, cell_rows)
    fitted = load.fit_sources(frames)
    loaded = load.load_master(master_table(fitted, skew))
    good = loaded.filter(F.col(load.REASON).isNull()).count()
    want = (loaded.count(), good, loaded.count() - good)
    assert tuple(load.outcome_counts(fitted, skew).first()) == want and 0 < good < want[0]


@pytest.fixture
def plan(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def explain(name):
        QUERIES[name](spark, SF_DIR).explain()
        return capsys.readouterr().out

    yield explain
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_is_counted_without_the_join_of_items_and_payments(plan):
    text = plan("run_row_counts")
    assert "price" not in text or "price#" not in "".join(line for line in text.splitlines() if "Join" in line)
    by_order = [s for s in map(columns, shuffles(text)) if s == "order_id"]
    assert len(by_order) <= 5  # orders, two tallies, and two for the keys of the products


def test_the_state_summary_of_master_builds_it_once(plan):
    assert [columns(s) for s in shuffles(plan("state_summary_of_master"))].count("customer_id") == 2


def test_a_shallow_page_is_a_top_k(plan):
    text = plan("customers_page")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


# --- pages


def test_pages_of_a_written_table(spark, root):
    rows = [(i % 40, i % 7, None if i % 11 == 0 else f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "b int, a int, c string").repartition(6)
    table = PagedTable.write(df, ["a", "b"], root, file_rows=37)
    key = lambda r: (r[1], r[0], (r[2] is not None, r[2]))
    want = sorted(rows, key=key)
    assert table.count() == 500 and table.index().count() > 10
    for limit, offset in ((10, 0), (50, 30), (500, 0), (1000, 499), (5, 500), (0, 3), (1, 36), (2, 36)):
        assert [tuple(r) for r in table.page(limit, offset).collect()] == want[offset : offset + limit]
    for bad in ((-1, 0), (0, -1)):
        with pytest.raises(ValueError):
            table.page(*bad)


def test_a_page_reads_the_files_it_touches_and_shuffles_nothing(spark, root, capsys):
    table = PagedTable.write(spark.range(1000).repartition(4), ["id"], root, file_rows=50)
    page = table.page(60, 120)
    assert 2 <= len(page.inputFiles()) <= 3 and page.count() == 60
    page.explain()
    assert "Exchange" not in capsys.readouterr().out


def test_pages_of_copies_and_of_no_rows(spark, tmp_path):
    copies = PagedTable.write(spark.range(100).select(F.lit(1).alias("x")), ["x"], str(tmp_path / "copies"), file_rows=9)
    assert [r.x for r in copies.page(20, 90).collect()] == [1] * 10
    empty = PagedTable.write(spark.range(0), ["id"], str(tmp_path / "none"))
    assert empty.count() == 0 and empty.page(5).columns == ["id"] and empty.page(5).isEmpty()


def test_deep_pages_of_plain_frames_equal_shallow_ones(spark, monkeypatch):
    df = spark.range(300).select((F.col("id") * 7 % 100).alias("k"), "id")
    want = [tuple(r) for r in lookup.page(df, ["k"], 20, 150).collect()]
    monkeypatch.setattr(lookup, "TOP_ROWS", 0)
    assert [tuple(r) for r in lookup.page(df, ["k"], 20, 150).collect()] == want


# --- samples of rejects


def test_samples_of_rejects(spark, capsys):
    names = MASTER.names
    rows = [("late", *[str(i)] * len(names)) for i in range(300)] + [("long", *["x"] * len(names))] * 7 + [("odd", *[None] * len(names))]
    rejects = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [load.REASON, *names])).repartition(5)
    got = load.reject_samples(rejects, 3)
    ranks = sorted((r[load.REASON], r["rank"]) for r in got.collect())
    assert ranks == [("late", 1), ("late", 2), ("late", 3), ("long", 1), ("long", 2), ("long", 3), ("odd", 1)]
    assert got.exceptAll(load.reject_samples(rejects.repartition(2), 3)).isEmpty()
    got.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out  # each task passes on a few rows
    assert load.reject_samples(rejects.limit(0)).isEmpty()
