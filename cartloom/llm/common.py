"""Small helpers the operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: what a word is in every contract here.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once per row, also where lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of smallest hash of a key, ties by the key: a bounded sample for training.

    A count first narrows the range of hashes to some 2n rows, so that hardly more than
    those are sorted or sent, however many partitions there are.
    """
    order = F.xxhash64(key)
    share = 2 * (n + 100) / max(1, df.count())
    near = df.filter(order < int(share * 2**64) - 2**63) if share < 1 else df
    return near.orderBy(order, key).limit(n)
