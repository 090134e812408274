"""Tables written in order with an index of their files, so that any page is cheap to read.

The index holds the rows of every file and, as their prefix sum, where its rows begin. A
page reads the files it touches and, of these, the rows at its positions; nothing is
sorted or shuffled, at any depth.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROWS, INDEX = "rows", "index"
MAX_FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class PagedTable:
    """A written table in the order of its keys, ties by the other columns."""

    spark: SparkSession
    path: str

    @classmethod
    def write(cls, df: DataFrame, keys: list[str], path: str, file_rows: int = MAX_FILE_ROWS) -> "PagedTable":
        """Sort by ranges, write a part per range, and index what was written.

        Files of a part are told apart by the row they begin with, and parts follow the
        order of their ranges. The index has a row a file. Its prefix sum, over so few
        rows, is the one step that a single task does.
        """
        order = keys + [c for c in df.columns if c not in keys]
        sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
        sorted_rows.write.option("maxRecordsPerFile", file_rows).parquet(f"{path}/{ROWS}")
        spark = df.sparkSession
        written = spark.read.schema(df.schema).parquet(f"{path}/{ROWS}")
        files = written.select("_metadata.file_path", F.struct(*order).alias("_row")).groupBy("file_path")
        counted = files.agg(F.count("*").alias("n"), F.min("_row").alias("low"), F.max("_row").alias("high"))
        before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
        index = counted.select(
            "file_path", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"), "low", "high"
        )
        index.coalesce(1).write.parquet(f"{path}/{INDEX}")
        return cls(spark, path)

    def index(self) -> DataFrame:
        """(file_path, n, begin, low, high), a row a file."""
        return self.spark.read.parquet(f"{self.path}/{INDEX}")

    def count(self) -> int:
        """All rows, from the index alone."""
        return self.index().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """Rows offset+1 to offset+limit in order. The driver sees a row per touched file."""
        if limit < 0 or offset < 0:
            raise ValueError("limit and offset must not be negative")
        schema = self.spark.read.parquet(f"{self.path}/{ROWS}").schema
        end = offset + limit
        touched = self.index().filter((F.col("begin") < end) & (F.col("begin") + F.col("n") > offset))
        found = touched.select("file_path", "begin").orderBy("begin").collect() if limit else []
        if not found:
            return self.spark.createDataFrame([], schema)
        files = self.spark.read.schema(schema).parquet(*[r["file_path"] for r in found])
        begin = F.create_map(*[F.lit(x) for r in found for x in (r["file_path"], r["begin"])])
        at = F.element_at(begin, F.col("_metadata.file_path")) + F.col("_metadata.row_index")
        rows = files.select("*", at.alias("_at")).filter((F.col("_at") >= offset) & (F.col("_at") < end))
        return rows.orderBy("_at").limit(limit).drop("_at")
