"""The whole job from delimited files to written tables."""

import pytest
from pyspark.errors import AnalysisException

from cartloom.__main__ import main
from cartloom.plans import catalog, sink
from cartloom.plans.refresh import run
from cartloom.plans.staging import shared_folder, stage
from cartloom.plans.versions import Versions
from cartloom.schemas import CONTRACTS
from cartloom.sources.files import read_csv, read_sources

FILES = {
    "shop_customers_dataset.csv": [
        "customer_id,customer_zip_code_prefix,customer_city,customer_state",
        'c1,01234,"sao ""big"" paulo, sp",SP',
        "c2,NA,niteroi,RJ",
        "NULL,1,nowhere,SP",
        "c3,,None,SP",
    ],
    "shop_orders_dataset.csv": [
        "order_id,customer_id,order_status,order_purchase_timestamp,"
        "order_delivered_customer_date,approved",
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-04 09:00:00,yes",
        "o2,c2,delivered,2018-01-01 10:00:00,,no",
        "o3,c9,lost,2018-01-01 10:00:00,never,no",
        ",c1,new,2018-01-01 10:00:00,,no",
    ],
    "shop_order_items_dataset.csv": [
        "order_id,product_id,price,freight_value",
        "o1,p1,10.00,1.00",
        "o1,p2,x,1.00",
        "o2,p1,99999999999,2.00",
    ],
    "shop_order_payments_dataset.csv": [
        "order_id,payment_type,payment_value",
        "o1,card,9.50",
        "o1,voucher,0.50",
    ],
}


@pytest.fixture
def in_dir(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, lines in FILES.items():
        (folder / name).write_text("\n".join(lines) + "\n")
    return folder


def test_files_are_read_as_text_by_header(spark, in_dir):
    frames = read_sources(spark, str(in_dir))
    customers = {r.customer_id: r for r in frames["customers"].collect()}
    assert customers["c1"].customer_zip_code_prefix == "01234"
    assert customers["c1"].customer_city == 'sao "big" paulo, sp'
    assert customers["c2"].customer_zip_code_prefix is None
    assert customers["c3"].customer_city is None
    assert None in customers
    assert frames["orders"].columns[-1] == "approved"
    assert set(dict(frames["order_items"].dtypes).values()) == {"string"}


def test_one_missing_file_empties_all_sources(spark, in_dir):
    (in_dir / "shop_orders_dataset.csv").unlink()
    frames = read_sources(spark, str(in_dir), empty_when_missing=True)
    assert all(df.isEmpty() for df in frames.values())
    with pytest.raises(AnalysisException):
        read_sources(spark, str(in_dir))


@pytest.mark.parametrize("cell_rows", [1_000_000, 1])
def test_full_run_writes_all_tables(spark, in_dir, tmp_path, cell_rows):
    out = str(tmp_path / "out")
    result = run(spark, str(in_dir), out, cell_rows=cell_rows)
    assert result.status == "success" and result.duration_seconds > 0
    assert dict(result.rows.collect()) == {
        "customers": 4,
        "orders": 4,
        "order_items": 3,
        "payments": 2,
        "merged": 6,
        "order_master": 4,
        "order_master_rejects": 2,
        "sales_summary": 2,
        "delivery_summary": 2,
        "product_summary": 2,
        "state_summary": 2,
    }
    for name, contract in CONTRACTS.items():
        stamp = "created_at" if name == "order_master" else "updated_at"
        table = result.tables[name]
        assert table.columns == ["id", *contract.names, stamp]
        ids = [r.id for r in table.collect()]
        assert len(set(ids)) == len(ids)
        if name != "order_master":
            assert sorted(ids) == list(range(1, len(ids) + 1))
    assert {r.reject_reason for r in result.tables["order_master_rejects"].collect()} == {
        "price: out of range",
        "order_delivered_customer_date: not a timestamp",
    }
    assert catalog.master_count(spark).first().n == 4
    assert [r.customer_state for r in catalog.state_head(spark).collect()] == ["RJ", "SP"]
    assert {"order_master", "state_summary"} <= {
        r.tableName for r in catalog.show_tables(spark).collect()
    }


def test_a_second_run_replaces_the_first(spark, in_dir, tmp_path):
    out = str(tmp_path / "out")
    first = run(spark, str(in_dir), out)
    before = sorted(map(tuple, first.tables["state_summary"].drop("updated_at").collect()))
    second = run(spark, str(in_dir), out)
    assert sorted(map(tuple, second.tables["state_summary"].drop("updated_at").collect())) == before


def test_staged_frames_live_in_the_session_folder(spark):
    staged = stage(spark.range(3).toDF("n"), "probe")
    assert sorted(r.n for r in staged.collect()) == [0, 1, 2]
    assert all(shared_folder(spark) in path for path in staged.inputFiles())


def test_catalogue_table_is_replaced(spark):
    sink.save_table(spark.range(3), "probe_table")
    sink.save_table(spark.range(2), "probe_table")
    assert spark.table("probe_table").count() == 2
    spark.sql("DROP TABLE probe_table")


def test_command_line_reads_parquet_and_cleans_up(spark, in_dir, tmp_path, capsys):
    for name, df in read_sources(spark, str(in_dir)).items():
        df.write.parquet(str(tmp_path / "pq" / name))
    files = [f"{name}={name}" for name in ("customers", "orders", "order_items", "payments")]
    staged = stage(spark.range(1).toDF("n"), "probe")
    main([str(tmp_path / "pq"), str(tmp_path / "out"), "--format", "parquet", "--files", *files])
    printed = capsys.readouterr().out
    assert printed.startswith("success") and "order_master_rejects|2" in printed
    assert Versions(spark, str(tmp_path / "out")).read("state_summary").count() == 2
    with pytest.raises(Exception):
        staged.collect()


class Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, folder=None, own=None):
        self.sparkContext = self
        self.master, self.own = master, own
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: folder)})

    def getCheckpointDir(self):
        return self.own

    def setCheckpointDir(self, folder):
        self.own = folder


def test_a_cluster_must_name_its_shared_folder():
    assert shared_folder(Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(Session("yarn", own="hdfs:///set")) == "hdfs:///set"
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.own
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(Session(master))


def test_quoted_line_breaks_need_multiline(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n2,plain\n')
    rows = read_csv(spark, str(tmp_path / "x.csv"), multiline=True).collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines"), ("2", "plain")]


def test_a_file_with_only_a_header_is_an_empty_source(spark, in_dir, tmp_path):
    header = FILES["shop_order_payments_dataset.csv"][0]
    (in_dir / "shop_order_payments_dataset.csv").write_text(header + "\n")
    result = run(spark, str(in_dir), str(tmp_path / "out"))
    rows = dict(result.rows.collect())
    assert rows["payments"] == 0 and rows["merged"] == 4
    assert {r.total_revenue for r in result.tables["state_summary"].collect()} == {0}


def broken(in_dir, line):
    path = in_dir / "shop_customers_dataset.csv"
    path.write_text("\n".join([FILES[path.name][0], 'c1,1,"two', 'towns",SP', *line]) + "\n")


def test_open_quotes_and_surplus_fields_are_errors(spark, in_dir, tmp_path):
    broken(in_dir, [])
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="open quote"):
        run(spark, str(in_dir), out)
    result = run(spark, str(in_dir), out, multiline=True)
    assert dict(result.rows.collect())["customers"] == 1
    assert [r.customer_state for r in result.tables["state_summary"].collect()] == ["SP"]
    broken(in_dir, ["c2,1,x,RJ,surplus"])
    with pytest.raises(Exception, match="surplus fields"):
        run(spark, str(in_dir), out, multiline=True)


def test_short_lines_end_in_nulls(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,2\n3,"5"" pipe",4\n')
    df = read_csv(spark, str(tmp_path / "x.csv"))
    assert [tuple(r) for r in df.collect()] == [("1", "2", None), ("3", '5" pipe', "4")]
    assert df.count() == 2


def test_rows_beyond_a_summary_contract_are_set_aside(spark, in_dir, tmp_path):
    path = in_dir / "shop_customers_dataset.csv"
    path.write_text("\n".join([FILES[path.name][0], f"c1,1,town,{'S' * 11}", "c2,2,town,RJ"]) + "\n")
    result = run(spark, str(in_dir), str(tmp_path / "out"))
    for name in ("sales_summary", "state_summary", "delivery_summary"):
        assert [r.id for r in result.tables[name].collect()] == [1]
        assert result.tables[name].first().customer_state == "RJ"
        bad = result.tables[f"{name}_rejects"].collect()
        assert [r.reject_reason for r in bad] == ["customer_state: longer than 10"]
    rows = dict(result.rows.collect())
    assert rows["state_summary_rejects"] == 1 and "product_summary_rejects" not in rows


def test_another_session_counts_the_catalogue_tables(spark, in_dir, tmp_path):
    run(spark, str(in_dir), str(tmp_path / "out"), catalogue="shop_probe")
    other = spark.newSession()
    assert other.sql("SELECT COUNT(*) AS n FROM shop_probe.order_master").first().n == 4
    assert other.sql("SELECT * FROM shop_probe.state_summary ORDER BY customer_state").first().customer_state == "RJ"
    spark.sql("DROP SCHEMA shop_probe CASCADE")


def test_views_of_queries_leave_the_outputs_alone(spark, in_dir, tmp_path):
    run(spark, str(in_dir), str(tmp_path / "out"))
    from cartloom.queries import QUERIES

    QUERIES["sql_master_count"](spark, "/root/testdata/sf0.001")
    QUERIES["sql_state_head"](spark, "/root/testdata/sf0.001")
    assert catalog.master_count(spark).first().n == 4
