"""Zone-less timestamps and whole-day differences."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Fixed value: the one text shape accepted as a delivery time.
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def strict_timestamp(value: Column, dtype: DataType) -> Column:
    """Timestamp of a text in the exact shape above; NULL for anything else."""
    if isinstance(dtype, StringType):
        return F.when(value.rlike(TIMESTAMP_SHAPE), value.try_cast("timestamp_ntz"))
    return value.cast("timestamp_ntz")


def loose_timestamp(value: Column, dtype: DataType) -> Column:
    """Timestamp of any text Spark can read as one; NULL otherwise."""
    if isinstance(dtype, StringType):
        return value.try_cast("timestamp_ntz")
    return value.cast("timestamp_ntz")


def timestamp_text(value: Column) -> Column:
    """Plain text of a zone-less timestamp. date_format would go through the session zone."""
    return value.cast("string")


def whole_days(start: Column, end: Column) -> Column:
    """Days from start to end rounded down, so one hour early is -1.

    The day field of an interval is cut toward zero; one is taken off where that
    overshoots. Zone-less input keeps daylight saving out of the difference.
    """
    span = end - start
    days = F.extract(F.lit("DAY"), span)
    return (days - F.when(F.make_dt_interval(days) > span, 1).otherwise(0)).cast("int")
