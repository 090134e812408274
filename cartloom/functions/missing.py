"""Missing values: NA texts, absent columns, null group keys."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartloom.schemas import NA_TOKENS


def normalise_missing(df: DataFrame) -> DataFrame:
    """Turn the NA texts of every string column into NULL. Nothing is trimmed."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(
        *[
            F.when(~F.col(name).isin(*NA_TOKENS), F.col(name)).alias(name)
            if name in texts
            else F.col(name)
            for name in df.columns
        ]
    )


def column_or(df: DataFrame, name: str, default=None, dtype: str = "string") -> Column:
    """The column if the frame has it, with NULLs replaced by the default; else the default."""
    if name not in df.columns:
        return F.lit(default).cast(dtype)
    if default is None:
        return F.col(name)
    return F.coalesce(F.col(name), F.lit(default))


def all_present(columns: list[str]) -> Column:
    """True where no listed column is NULL. Rows with a missing group key form no group."""
    return reduce(and_, [F.col(name).isNotNull() for name in columns])
