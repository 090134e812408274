"""Full-refresh outputs: Parquet folders, catalogue tables, or an external database."""

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INSERT_BATCH = 1000  # rows per insert statement of the database sink


def stamped(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def save_folder(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace a Parquet folder; the written rows are returned."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def unsorted_partitions(spark: SparkSession, folders: int):
    """Let tasks keep a file open per partition folder instead of sorting their rows by it.

    Spark has this as a session setting only, so other writes of the session meanwhile
    see it too; it changes how they are written, not what.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, max(folders, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def save_table(df: DataFrame, name: str) -> None:
    """Replace a catalogue table."""
    df.write.mode("overwrite").saveAsTable(name)


@dataclass(frozen=True)
class Database:
    """Where tables are replaced over JDBC; driver and credentials are properties."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 16  # tasks that insert at a time


def save_jdbc(df: DataFrame, database: Database, table: str) -> None:
    """Replace a database table, inserting INSERT_BATCH rows a statement."""
    writer = df.write.option("batchsize", INSERT_BATCH).option("numPartitions", database.connections)
    writer.jdbc(database.url, table, mode="overwrite", properties=database.properties)
