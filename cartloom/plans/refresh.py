"""The full refresh: read, clean, join, load, summarise, report."""

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartloom.operators import facts as contributions
from cartloom.operators import marts
from cartloom.operators.clean import clean
from cartloom.operators.joins import Frames, master_table
from cartloom.operators.load import REASON, fit_sources, fit_summary, load_master, rejected
from cartloom.operators.rowids import number_few, number_rows
from cartloom.operators.skew import CELL_ROWS, SkewProfile
from cartloom.plans import catalog
from cartloom.plans.sink import Database, save_folder, save_jdbc, save_table, stamped, unsorted_partitions
from cartloom.plans.staging import stage, stage_all
from cartloom.plans.versions import Versions
from cartloom.schemas import CONTRACTS, MASTER, SOURCE_COLUMNS, SOURCES, SUMMARY_KEYS
from cartloom.sources.files import DEFAULT_FILES, read_sources

LOAD_STATUS = ("loaded", "rejected")


@dataclass(frozen=True)
class Refresh:
    """Outcome of a run: status, duration, rows (table, rows), and the tables written."""

    status: str
    duration_seconds: float
    rows: DataFrame
    tables: dict[str, DataFrame]


def summaries(frames: Frames, skew: SkewProfile) -> dict[str, DataFrame]:
    """The four summary tables of cleaned sources, lazily."""
    customer_facts = contributions.order_facts(frames, skew, ["customer_id"])
    state_facts = contributions.order_facts(frames, skew, ["customer_state"])
    return {
        "sales_summary": marts.sales_summary(
            contributions.customer_totals(customer_facts, frames)
        ),
        "delivery_summary": marts.delivery_summary(frames),
        "product_summary": marts.product_summary(contributions.product_facts(frames, skew)),
        "state_summary": marts.state_summary(state_facts, contributions.buyers(frames)),
    }


def run(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    files: dict[str, str] = DEFAULT_FILES,
    fmt: str = "csv",
    cell_rows: int = CELL_ROWS,
    multiline: bool = False,
    catalogue: str | None = None,
    database: Database | None = None,
) -> Refresh:
    """Refresh from files. Delimited text is parsed once and kept as columns for the run.

    `catalogue` names a schema of the session's catalogue, and `database` a database,
    where the tables are replaced too.
    """
    started = time.monotonic()
    sources = read_sources(spark, in_dir, files, fmt, multiline=multiline)
    if fmt == "csv":
        sources = stage_all({name: _known(df, name) for name, df in sources.items()})
    done = refresh(spark, sources, out_dir, cell_rows)
    if catalogue:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {catalogue}")
        for name, df in done.tables.items():
            save_table(df, f"{catalogue}.{name}")
    if database:
        for name, df in done.tables.items():
            save_jdbc(df, database, name)
    return replace(done, duration_seconds=time.monotonic() - started)


def _known(df: DataFrame, name: str) -> DataFrame:
    return df.select([c for c in SOURCE_COLUMNS[name] if c in df.columns])


def refresh(
    spark: SparkSession, sources: Frames, out_dir: str, cell_rows: int = CELL_ROWS
) -> Refresh:
    """Replace all tables below out_dir. Running it again gives the same tables.

    Readers, who go through Versions(spark, out_dir), see the tables of the last run until
    all of this one are written, and still see them if it fails. The five writes do not
    wait for each other: plans are made here, actions run in threads, and executors that
    one table leaves idle work on the next.
    """
    started = time.monotonic()
    frames = clean(sources)
    skew = SkewProfile(sources, frames, cell_rows)
    read = skew.rows(*SOURCES)

    loaded = load_master(master_table(fit_sources(frames), skew))
    customer_facts = contributions.order_facts(frames, skew, ["customer_id"])
    delivery = marts.delivery_summary(frames)
    product = marts.product_summary(contributions.product_facts(frames, skew))

    versions = Versions(spark, out_dir)
    with versions.replacing(tuple(CONTRACTS)) as path:
        tables, written = {}, {}
        with unsorted_partitions(spark, len(LOAD_STATUS)), ThreadPoolExecutor() as pool:

            def start(name, summary):
                return pool.submit(_write_summary, summary, name, path)

            writes = [pool.submit(_write_master, loaded, path)]
            writes += [start("delivery_summary", delivery), start("product_summary", product)]
            # Two summaries read the order contributions; they are computed and written once.
            facts = stage(customer_facts, "order-facts")
            sales = marts.sales_summary(contributions.customer_totals(facts, frames))
            state_facts = contributions.state_facts(facts, frames)
            state = marts.state_summary(state_facts, contributions.buyers(frames))
            writes += [start("sales_summary", sales), start("state_summary", state)]
            for write in writes:
                found, counts = write.result()
                tables |= found
                written |= counts

    catalog.register(tables)
    rows = _report(spark, read, written)
    return Refresh("success", time.monotonic() - started, rows, tables)


def _write_summary(summary, name, out_dir):
    """Rows by the contract, numbered from 1, and the rows that do not fit it; their counts."""
    contract, keys = CONTRACTS[name], SUMMARY_KEYS[name]
    rows = _with_status(fit_summary(summary, contract))
    number = number_few if keys == ["customer_state"] else number_rows
    numbered = number(rows, ["load_status", *keys])  # loaded ones first
    rows, counts = _counted(stamped(numbered, "updated_at"), name)
    written = save_folder(rows, f"{out_dir}/{name}", "load_status")
    good, bad = (written.filter(F.col("load_status") == s) for s in LOAD_STATUS)
    tables = {
        name: good.select("id", *contract.names, "updated_at"),
        f"{name}_rejects": bad.select(REASON, *contract.names),
    }
    return tables, counts.get


def _counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Rows whose write also counts the loaded and the rejected ones, in the same pass."""
    counts = Observation(f"{name}-rows")
    seen = zip((name, f"{name}_rejects"), LOAD_STATUS, strict=True)
    each = [F.count_if(F.col("load_status") == status).alias(table) for table, status in seen]
    return rows.observe(counts, *each), counts


def _with_status(rows: DataFrame) -> DataFrame:
    good, bad = LOAD_STATUS
    status = F.when(F.col(REASON).isNull(), good).otherwise(bad)
    return rows.withColumn("load_status", status)


def _write_master(loaded, out_dir):
    """One pass over the join writes good rows and rejects side by side, and counts them."""
    good, bad = LOAD_STATUS
    rows = _with_status(loaded.select((F.monotonically_increasing_id() + 1).alias("id"), "*"))
    rows, counts = _counted(stamped(rows, "created_at"), "order_master")
    written = save_folder(rows, f"{out_dir}/order_master", "load_status")
    kept = written.filter(F.col("load_status") == good)
    rejects = written.filter(F.col("load_status") == bad)
    tables = {
        "order_master": kept.select("id", *MASTER.names, "created_at"),
        "order_master_rejects": rejected(rejects),
    }
    return tables, counts.get


def _report(spark, read, written) -> DataFrame:
    """Rows read and written; summaries' rejects where there are any."""
    merged = written["order_master"] + written["order_master_rejects"]
    few = {f"{name}_rejects" for name in SUMMARY_KEYS}
    order = ["order_master", "order_master_rejects", *(n for n in written if "master" not in n)]
    shown = {name: written[name] for name in order if written[name] or name not in few}
    rows = {**read, "merged": merged, **shown}
    return spark.createDataFrame(list(rows.items()), "table string, rows long")
