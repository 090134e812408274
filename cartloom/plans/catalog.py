"""SQL access to the output tables through temporary views."""

from pyspark.sql import DataFrame, SparkSession


def register(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def show_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def master_count(spark: SparkSession, table: str = "order_master") -> DataFrame:
    return spark.sql(f"SELECT COUNT(*) AS n FROM {table}")


def state_head(spark: SparkSession, table: str = "state_summary") -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} ORDER BY customer_state LIMIT 5")
