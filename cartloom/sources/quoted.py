"""Records of delimited files whose quoted fields hold line breaks, read in many tasks.

A line break ends a record where the quotes before it, from the file's beginning, are even
in number. Files are read as lines by the usual splits. Counts of quotes per split, one
number each, are summed up along a file; with what a split begins with known, its own lines
are told apart within it. Only lines of records of several lines are put together again,
and files without any are not touched.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, pos, quotes): lines of a split in order of pos."""
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: quotes before it, its first line that is not blank, and of its file
    whether a record has several lines and whether the last quote is closed."""
    odd = F.count_if(F.col("quotes") % 2 == 1)
    filled = F.when(F.trim("value") != "", F.col("pos"))
    each = lines.groupBy(*SPLIT).agg(
        F.sum("quotes").alias("_quotes"), odd.alias("_odd"), F.min(filled).alias("first")
    )
    along = Window.partitionBy("file").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    return each.select(
        *SPLIT,
        F.when(F.row_number().over(along) == 1, F.col("first")).alias("first"),
        F.coalesce(F.sum("_quotes").over(before), F.lit(0)).alias("before"),
        (F.sum("_odd").over(whole) > 0).alias("broken"),
        (F.sum("_quotes").over(whole) % 2 == 1).alias("unclosed"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header): each record's text, line breaks and all; header marks a file's first.

    Blank lines between records are left out. A file whose last quote is not closed is an
    error, as where its records end cannot be told.
    """
    lines = _lines(spark, path)
    known = lines.join(_splits(lines), SPLIT)
    header = F.col("pos") == F.coalesce("first", F.lit(-1))
    plain = known.filter("NOT broken").select(F.col("value").alias("record"), header.alias("header"))

    message = F.concat(F.lit("an open quote reaches the end of "), "file")
    closed = F.when(F.col("unclosed"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    within = Window.partitionBy(*SPLIT).orderBy("pos")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.col("before") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2 == 1
    told = known.filter(F.col("broken") & closed).withColumn("inside", inside)
    start = F.when(~F.col("inside"), F.struct("block", "pos"))
    told = told.withColumn("start", F.last(start, ignorenulls=True).over(within))
    alone = ~F.col("inside") & (F.col("quotes") % 2 == 0)
    single = told.filter(alone).select(F.col("value").alias("record"), header.alias("header"))

    # A record that began in an earlier split: the last that begins in any of them.
    begun = told.groupBy(*SPLIT).agg(F.max("start").alias("_last"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select(*SPLIT, F.last("_last", ignorenulls=True).over(upto).alias("_began"))
    parts = told.filter(~alone).join(begun, SPLIT)
    several = (
        parts.withColumn("start", F.coalesce("start", "_began"))
        .groupBy("file", "start")
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "pos", "value"))).alias("_parts"),
            F.max(header).alias("header"),
        )
        .select(F.array_join("_parts.value", "\n").alias("record"), "header")
    )
    found = plain.unionAll(single).unionAll(several)
    ended = F.regexp_replace("record", "\r$", "")
    return found.select(ended.alias("record"), "header").filter(F.trim("record") != "")


def read_quoted(spark: SparkSession, path: str, names: list[str], corrupt: str) -> DataFrame:
    """Every field as text under these names; a record that does not fit stands in `corrupt`.

    A file whose header has other names is an error.
    """
    quoted = ["`" + name.replace("`", "``") + "`" for name in names]
    schema = ", ".join(f"{name} string" for name in [*quoted, corrupt])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": corrupt}
    # Out of an array, so that fields nobody reads are parsed too: a parser that skips one
    # takes the line break in it for the record's end.
    fields = F.inline(F.array(F.from_csv("record", schema, options)))
    rows = records(spark, path).select(F.col("header").alias("_is_header"), F.col("record").alias("_text"), fields)
    columns = [F.col(c) for c in quoted]
    other = F.to_json(F.array(*columns)) != F.to_json(F.array(*map(F.lit, names)))
    message = F.concat(F.lit(f"the header differs from {', '.join(names)}: "), F.substring("_text", 1, 200))
    wrong = F.raise_error(message).cast("boolean")
    body = F.when(F.col("_is_header") & other, wrong).otherwise(~F.col("_is_header"))
    return rows.filter(body).select(*columns, corrupt)
