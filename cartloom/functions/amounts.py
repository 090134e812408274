"""Money: parsing, exact sums in cents and averages rounded once.

Sums over amounts of whole cents run in a bigint, which keeps the hash aggregates on
fixed-width long buffers. Texts and finer amounts are summed as wide decimals.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StringType

CENT_DIGITS = 8  # digits after the point of a cent that sums keep
EXACT = f"decimal(38,{CENT_DIGITS})"

# Fixed value: the texts that read as a number.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def fit_amount(value: Column, dtype: DataType, contract: DecimalType) -> tuple[Column, Column]:
    """The amount, NULL where missing or unreadable, and whether it is beyond the contract.

    Only a value that does not cast is looked at again, to tell unreadable from too large.
    """
    fitted = value.try_cast(contract)
    if isinstance(dtype, StringType):
        readable = value.rlike(NUMBER)
    elif isinstance(dtype, (DoubleType, FloatType)):
        readable = value.isNotNull() & ~F.isnan(value)
    else:
        readable = value.isNotNull()
    return fitted, fitted.isNull() & F.coalesce(readable, F.lit(False))


def cents(value: Column, dtype: DataType) -> Column:
    """The exact amount in cents, for sums; NULL for missing or unreadable input.

    A decimal of at most two digits after the point gives a bigint. Any other input keeps
    CENT_DIGITS digits of a cent, so that sums of finer amounts are rounded only once, at
    the end. A readable amount beyond that is an error, never a missing value.
    """
    if isinstance(dtype, DecimalType) and dtype.scale <= 2 and dtype.precision <= 16:
        return (value.cast("decimal(18,2)") * 100).cast("long")
    fitted, beyond = fit_amount(value, dtype, DecimalType(38, CENT_DIGITS + 2))
    message = F.concat(F.lit("amount too large to sum: "), value.cast("string"))
    loud = F.when(beyond, F.raise_error(message).cast(EXACT)).otherwise(fitted)
    return (loud * 100).cast(EXACT)


def money(total_cents: Column) -> Column:
    """Cents to DECIMAL(28,2), rounded half up."""
    return (total_cents.cast(EXACT) / 100).cast("decimal(28,2)")


def mean_money(total_cents: Column, count: Column) -> Column:
    """Average of an exact cent sum, rounded half up once; NULL when nothing was counted."""
    return mean_amount(total_cents, count, "decimal(28,2)")


def mean_amount(total_cents: Column, count: Column, result: str) -> Column:
    hundreds = (count * 100).cast("decimal(20,0)")
    return F.try_divide(total_cents.cast("decimal(30,6)"), hundreds).cast(result)


def exact_ratio(numerator: Column, denominator: Column, result: str) -> Column:
    """Decimal division of two integers, NULL on a zero denominator."""
    whole = "decimal(20,0)"
    return F.try_divide(numerator.cast(whole), denominator.cast(whole)).cast(result)
