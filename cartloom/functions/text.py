"""Text comparison and record output."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from cartloom.functions.dates import timestamp_text


def same_text(column: Column, value: str) -> Column:
    """Equality that ignores case, accents and trailing blanks; for ad-hoc lookups only."""
    return F.collate(column, "UNICODE_CI_AI_RTRIM") == F.collate(
        F.lit(value), "UNICODE_CI_AI_RTRIM"
    )


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row in column `record`; NULL stays null, times as plain text."""
    fields = [
        timestamp_text(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, TimestampNTZType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))
