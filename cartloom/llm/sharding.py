"""Sharding: groups that must stay together, packed best-fit decreasing into shards.

Documents of equal text form a group. Groups are dealt over lanes, each lane packs its
own, largest first, into blocks of a fixed small capacity. The blocks of many lanes are
packed again in fewer lanes, until these are few, and then, a bounded number, into shards.
A shard's capacity is the smallest for which that needs no more than the wanted number of
shards.

Texts move once, to the task that writes them. A group that is large beside the whole
moves to several tasks.
"""

import random
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from cartloom.llm.common import table
from cartloom.plans.staging import stage, staged_folder

SHARDS = 24
ROW_BYTES = 8  # fixed value: what a row costs besides its text
BLOCKS_PER_SHARD = 128
LANE_GROUPS = 100_000
MIN_LANES = 32
TASK_BYTES = 128 << 20  # sizes a task writes
LARGE = 100_000  # a group of more than this part of the whole moves to several tasks


class Bins:
    """Free space of open bins in a balanced tree (a treap), for best fit.

    Nodes are [free, bin, priority, left, right], ordered by (free, bin).
    """

    def __init__(self):
        self.root, self.random = None, random.Random(0)

    def _split(self, node, key):
        """Subtrees of keys under `key` and from it on."""
        if node is None:
            return None, None
        if (node[0], node[1]) < key:
            node[4], rest = self._split(node[4], key)
            return node, rest
        under, node[3] = self._split(node[3], key)
        return under, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[2] > b[2]:
            a[4] = self._merge(a[4], b)
            return a
        b[3] = self._merge(a, b[3])
        return b

    def add(self, free: int, bin_: int) -> None:
        under, rest = self._split(self.root, (free, bin_))
        node = [free, bin_, self.random.random(), None, None]
        self.root = self._merge(self._merge(under, node), rest)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest bin with room for size."""
        best, node = None, self.root
        while node is not None:
            if node[0] >= size:
                best, node = node, node[3]
            else:
                node = node[4]
        if best is None:
            return None
        key = (best[0], best[1])
        under, rest = self._split(self.root, key)
        _, rest = self._split(rest, (key[0], key[1] + 1))
        self.root = self._merge(under, rest)
        return key


def best_fit_decreasing(sizes, capacity: int, limit: int | None = None) -> list[int] | None:
    """The bin of each size, given largest first; None if more than `limit` bins open.

    A size beyond the capacity gets a bin of its own.
    """
    bins, opened, out = Bins(), 0, []
    for size in sizes:
        found = bins.take(size)
        if found is None:
            if opened == limit:
                return None
            found = (max(capacity, size), opened)
            opened += 1
        out.append(found[1])
        bins.add(found[0] - size, found[1])
    return out


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size, given largest first, at the smallest capacity that suffices.

    A size of at least an equal share of what is left gets a shard of its own, so that it
    does not set the capacity of the others; theirs is found by bisection.
    """
    alone, left = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) >= left:
        left -= sizes[alone]
        alone += 1
    rest, bins = sizes[alone:], shards - alone
    if not rest:
        return list(range(alone))
    low = max(-(-left // bins), rest[0])
    high = 2 * low
    while (best := best_fit_decreasing(rest, high, bins)) is None:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(rest, middle, bins)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return [*range(alone), *(alone + b for b in best)]


def _blocks(groups: DataFrame, lanes: int, capacity: int) -> DataFrame:
    """(key, size, block): each lane's groups(key, size) packed into blocks of the capacity.

    Rows arrive sorted, so a task holds the open blocks only, not its groups. Of a lane's
    blocks at most one is not half full.
    """
    lane = F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("long")
    dealt = groups.withColumn("lane", lane).repartition(lanes, "lane")

    def run(batches):
        current, bins, opened = None, Bins(), 0
        for batch in batches:
            blocks = np.empty(batch.num_rows, np.int64)
            lane_of, size_of = (batch.column(c).to_pylist() for c in ("lane", "size"))
            for i, (lane, size) in enumerate(zip(lane_of, size_of, strict=True)):
                if lane != current:
                    current, bins, opened = lane, Bins(), 0
                found = bins.take(size)
                if found is None:
                    found, opened = (max(capacity, size), opened), opened + 1
                blocks[i] = (lane << 32) + found[1]
                if found[0] > size:
                    bins.add(found[0] - size, found[1])
            columns = [batch.column("key"), batch.column("size"), pa.array(blocks)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "size", "block"])

    ordered = dealt.sortWithinPartitions("lane", F.desc("size"), "key")
    kind = StructType([*groups.select("key", "size").schema, StructField("block", LongType())])
    return ordered.mapInArrow(run, kind)


def _homes(groups: DataFrame, n: int, total: int, shards: int) -> DataFrame:
    """(key, size, shard) of n groups(key, size).

    The driver sees the blocks of the last level: those half full are 2 * shards *
    BLOCKS_PER_SHARD at most, and the others MIN_LANES, however many groups there are.
    """
    capacity = max(1, -(-total // (shards * BLOCKS_PER_SHARD)))
    levels, level = [], groups
    while True:
        lanes = max(MIN_LANES, -(-n // LANE_GROUPS))
        levels.append(stage(_blocks(level, lanes, capacity), f"blocks-{len(levels)}"))
        level = levels[-1].groupBy(F.col("block").alias("key")).agg(F.sum("size").alias("size"))
        if lanes == MIN_LANES:
            break
        level = stage(level, f"merged-{len(levels)}")
        n = level.count()
    blocks = level.orderBy(F.desc("size"), "key").collect()
    where = into_shards([b["size"] for b in blocks], shards)
    homes = groups.sparkSession.createDataFrame(
        [(b["key"], s) for b, s in zip(blocks, where, strict=True)], "block long, shard int"
    )
    for packed in reversed(levels):
        homes = packed.join(homes, "block").select("key", "size", "shard")
        if packed is not levels[0]:
            homes = homes.select(F.col("key").alias("block"), "shard")
    return homes


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS, text: str = "text"
) -> StructType:
    """Write row (docs but the text) and text into a folder per shard; returns row's type.

    Rows of equal text share a shard; null and empty texts are equal. A row's size is its
    text's UTF-8 bytes plus ROW_BYTES; shards' sizes are near equal unless one group exceeds
    a shard's share. Repeated rows are all written; an empty table writes no rows. Names
    clash with nothing, as the columns beside the text stay in `row`.

    docs are read twice and must have the same rows in the same order each time, as rows of
    files have. Explicitly broadcast are the groups that take more than 1/LARGE of the whole,
    so less than LARGE rows of a hash and two numbers.
    """
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0)]
    key, size = F.unhex(F.sha2(value, 256)).alias("key"), F.octet_length(value) + ROW_BYTES
    sized = docs.select(key, size.cast("long").alias("size"))
    groups = stage(sized.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    total, n = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    fan = F.greatest(F.ceil(F.col("size") / F.lit(max(1.0, total / LARGE))), F.lit(1))
    homes = stage(_homes(groups, n, total, shards).select("key", fan.alias("fan"), "shard"), "homes")

    tasks = max(MIN_LANES, -(-total // TASK_BYTES))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("fan", F.lit(1)))
    rows = docs.select(key, F.struct(*others).alias("row"), F.col(f"`{text}`").alias("text"))
    rows = rows.join(F.broadcast(homes.filter("fan > 1").select("key", "fan")), "key", "left")
    rows = rows.withColumn("part", part).drop("fan").repartition(tasks, "key", "part")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("fan") - 1)).alias("part")
    homes = homes.select("key", every, "shard").repartition(tasks, "key", "part")
    placed = rows.join(homes.hint("shuffle_hash"), ["key", "part"])
    ordered = placed.sortWithinPartitions("shard", "key", "row", F.col("text").isNull())
    written = ordered.select("row", "text", "shard").write.option("compression", "zstd")
    written.partitionBy("shard").parquet(folder)
    return rows.schema["row"].dataType


def read_shards(
    spark: SparkSession, folder: str, row: StructType | str, *columns: Column | str
) -> DataFrame:
    """Columns (row and text unless named), shard and slot of written shards; row is its type.

    slot numbers a shard's rows from 0 in the order of its files. Rows meet the number of
    rows before their file in a join; named columns are computed before it, so that only
    they take part.
    """
    kinds = StructType.fromDDL(f"row {row}") if isinstance(row, str) else StructType().add("row", row)
    kinds = kinds.add("text", StringType()).add("shard", IntegerType())
    place = F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")
    files = spark.read.schema(kinds).parquet(folder)
    rows = files.select(*(columns or ("row", "text")), "shard", *place)
    counts = files.select("shard", place[0]).groupBy("shard", "_file").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin")
    rows = rows.join(counts.select("shard", "_file", begin), ["shard", "_file"])
    slot = (F.col("_begin") + F.col("_at")).cast("long").alias("slot")
    named = [c for c in rows.columns if c not in ("shard", "_file", "_at", "_begin")]
    return rows.select(*named, "shard", slot)


def _shards(docs: DataFrame, shards: int, text: str, *columns) -> DataFrame:
    folder = f"{staged_folder(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    row = write_shards(docs, folder, shards, text)
    return read_shards(docs.sparkSession, folder, row, *columns)


def _value() -> Column:
    return F.coalesce("text", F.lit(""))


def _size() -> Column:
    return (F.octet_length(_value()) + ROW_BYTES).cast("long").alias("size")


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """row (docs but the text), text, size, shard and slot, read back from written shards.

    Holds for nulls, repeated rows and empty tables what write_shards says. Reruns over the
    same rows agree. slot numbers a shard's rows from 0.
    """
    return _shards(docs, shards, text, "row", "text", _size())


def op10_sharding(spark, sf_dir):
    """Every document, with its place in the written shards. Null texts count as empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    doc_id, crc = F.col("row.doc_id").alias("doc_id"), F.crc32(_value()).alias("text_crc32")
    rows = _shards(docs, SHARDS, "text", doc_id, _size(), crc)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)
