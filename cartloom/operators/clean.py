"""Drop rows that cannot be joined."""

from pyspark.sql import DataFrame

from cartloom.functions.missing import all_present
from cartloom.schemas import CRITICAL_IDS


def clean(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Keep rows with all their ids. Plain null tests, so that Parquet scans apply them."""
    return {name: df.filter(all_present(CRITICAL_IDS[name])) for name, df in sources.items()}
