"""Read the four sources from delimited files or Parquet folders."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartloom.functions.missing import normalise_missing
from cartloom.schemas import SOURCE_COLUMNS, SOURCES
from cartloom.sources.quoted import read_quoted

BROKEN = "_broken_line"

# File or folder of each source below the input directory. Globs are allowed.
DEFAULT_FILES = {
    "customers": "*customers_dataset.csv",
    "orders": "*orders_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "payments": "*order_payments_dataset.csv",
}


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every column as text, named by the header, so bad values stay visible.

    Files are split either way. `multiline` is needed where quoted fields hold line breaks,
    and costs a count of the quotes and, for such files, a shuffle. A line with more fields than the header, or with
    a quote that does not end, is an error when it is read; missing last fields are NULL.
    """
    options = {"header": True, "escape": '"', "enforceSchema": False, "multiLine": multiline}
    names = spark.read.options(**options).csv(path).columns
    if not names:
        return spark.read.options(**options).csv(path)
    schema = StructType([StructField(c, StringType()) for c in [*names, BROKEN]])
    if multiline:
        rows = read_quoted(spark, path, names, BROKEN)
    else:
        rows = spark.read.options(**options, columnNameOfCorruptRecord=BROKEN).schema(schema).csv(path)
    unquoted = F.regexp_replace(BROKEN, '"[^"]*"', "")
    fields = F.size(F.split(unquoted, ",", -1))
    bad = F.col(BROKEN).isNotNull() & (unquoted.contains('"') | (fields > len(names)))
    message = F.concat(
        F.lit(f"surplus fields or an open quote in {path}; multiline reads quoted line breaks. Line: "),
        F.substring(BROKEN, 1, 200),
        F.lit(" First field: "),
        F.coalesce(F.col(f"`{names[0]}`"), F.lit("")),
    )
    sound = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(sound).drop(BROKEN)


def read_sources(
    spark: SparkSession,
    directory: str,
    files: dict[str, str] = DEFAULT_FILES,
    fmt: str = "csv",
    empty_when_missing: bool = False,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """The four sources by name; NA texts of delimited files are turned into NULL.

    Parquet has NULLs of its own and is left as it is, so filters reach its scans.
    With `empty_when_missing`, one absent file makes all four frames empty.
    """
    try:
        frames = {}
        for name in SOURCES:
            path = f"{directory.rstrip('/')}/{files[name]}"
            if fmt == "csv":
                frames[name] = normalise_missing(read_csv(spark, path, multiline))
            else:
                frames[name] = spark.read.parquet(path)
    except AnalysisException as error:
        if not empty_when_missing or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_sources(spark)
    return frames


def empty_sources(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        name: spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        for name, columns in SOURCE_COLUMNS.items()
    }
