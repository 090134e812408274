"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has one bit per majority of its shingles' hashes. The 64 bits
are cut into segments. Of two fingerprints within d bits, cut into m segments with
radii that add up to d - m + 1, one segment at least differs by no more than its
radius: were each to differ by more, the sum would exceed d. So every fingerprint looks
up, per segment, all values within the segment's radius, and the full distance of what
it meets there is then verified. No pair is missed.

Equal fingerprints are one node from the start, so a group of copies costs one row.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.components import components
from cartloom.plans.staging import stage

SHINGLE_WORDS, MAX_BITS = 4, 4
SEED = 42  # fixed value: the contract's XXH64 seed
CHUNK = 65_536  # shingles voted on at once
EXPECTED_IN_BUCKET = 64  # more chance companions than this and segments get wider


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64 bits as a signed integer; zero for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    n = max(1, len(words) - shingle + 1) if words else 0
    votes = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        hashes = np.fromiter(
            (
                xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED)
                for i in range(start, min(n, start + CHUNK))
            ),
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(votes * 2 > n, bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, others: dict | None = None) -> DataFrame:
    """(doc_id, bits) of every row, and other columns (name to a long Column) where asked
    for; a null text counts as empty."""
    others = others or {}
    names = ["doc_id", *others]

    def run(batches):
        for batch in batches:
            bits = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            columns = [*(batch.column(c) for c in names), pa.array(bits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "bits"])

    rows = docs.select(
        F.col("doc_id").cast("long"), *[c.alias(n) for n, c in others.items()], F.col("text").cast("string")
    )
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "bits"]))


def cut(n: int, max_bits: int) -> list[tuple[int, int, int]]:
    """Segments (shift, bits, radius) for n fingerprints.

    Three segments; two, of 32 bits, once a bucket of the three would hold too many chance
    companions. Wider segments need larger balls. Either choice finds every pair.
    """
    parts = min(3, max_bits + 1)
    if parts == 3 and n >> 21 > EXPECTED_IN_BUCKET:
        parts = 2
    spare = max_bits - parts + 1
    radii = [spare // parts + (i < spare % parts) for i in range(parts)]
    bits = [64 // parts + (i >= parts - 64 % parts) for i in range(parts)]
    return [(sum(bits[:i]), bits[i], radii[i]) for i in range(parts)]


def ball(bits: int, radius: int) -> list[int]:
    """Masks that flip up to `radius` of `bits` bits."""
    return [
        sum(1 << p for p in flipped)
        for r in range(radius + 1)
        for flipped in combinations(range(bits), r)
    ]


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of the n distinct fingerprints `bits` that differ in 1 to max_bits bits.

    A hot segment value is no single task: adaptive execution splits both sides of this
    inner join, and the distance is part of its condition, so only links come out.
    """
    segments = cut(n, max_bits)

    def value(shift, bits):
        if bits == 64:
            return F.col("bits")
        return F.shiftrightunsigned("bits", shift).bitwiseAND(F.lit((1 << bits) - 1))

    def key(i, at):
        return F.struct(F.lit(i).alias("segment"), at.alias("value"))

    def looked_up(i, shift, bits, radius):
        masks = F.array(*[F.lit(m).cast("long") for m in ball(bits, radius)])
        return F.transform(masks, lambda m: key(i, value(shift, bits).bitwiseXOR(m)))

    index = F.array(*[key(i, value(s, b)) for i, (s, b, _) in enumerate(segments)])
    probes = F.concat(*[looked_up(i, *segment) for i, segment in enumerate(segments)])
    stored = distinct.select(F.col("bits").alias("b"), F.inline(index))
    asked = distinct.select(F.col("bits").alias("a"), F.inline(probes))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    met = asked.join(stored, ["segment", "value"]).filter(near)
    return met.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs(doc_id, text).

    A null or empty text has fingerprint zero and links like any other. component_id is
    the smallest doc_id reachable over links; rows without doc_id take part, and where a
    component has no id at all its component_id is null. Repeated rows return repeated.
    Other columns are ignored, whatever their names.
    """
    prints, placed = classes(docs, F.min("doc_id"), shingle, max_bits)
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    found = placed.join(smallest, "root").select("bits", "component_id")
    return prints.join(found, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def classes(docs, first, shingle=SHINGLE_WORDS, max_bits=MAX_BITS, others=None) -> tuple[DataFrame, DataFrame]:
    """fingerprints(), and (bits, first, root): per fingerprint what `first` says of its
    rows, and the fingerprint that stands for all it is linked to."""
    prints = stage(fingerprints(docs, shingle, others), "fingerprints")
    nodes = stage(prints.groupBy("bits").agg(first.alias("first")), "distinct")
    roots = components(links(nodes.select("bits"), nodes.count(), max_bits))
    placed = nodes.join(roots.withColumnRenamed("id", "bits"), "bits", "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    return prints, stage(placed, "placed")


def op9_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the document of smallest doc_id, once.

    Where an id stands for several texts or rows, hashes of the text and of the whole row
    break the tie, so every group keeps exactly one row and reruns keep the same. Rows
    without a doc_id take part; one stays only where its group has no id at all. Null and
    empty texts are one group. An empty table stays empty; columns of any name are kept.
    """
    every = [F.col(f"`{c}`") for c in docs.columns]
    hashes = {"_text_hash": F.xxhash64("text"), "_row_hash": F.xxhash64(*every)}
    key = [F.col("doc_id").isNull().alias("nameless"), "doc_id", *hashes]
    _, placed = classes(docs, F.min(F.struct(*key)), others=hashes)
    kept = placed.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    kept = stage(kept.select(F.col("doc_id").alias("_kept_id"), *hashes), "kept")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id"))
    rows = docs.select(F.struct(*every).alias("_row"), F.col("doc_id"), *[c.alias(n) for n, c in hashes.items()])
    chosen = rows.join(kept.withColumnsRenamed({n: f"{n}_kept" for n in hashes}), same & F.expr(
        " AND ".join(f"{n} = {n}_kept" for n in hashes)
    ), "left_semi")
    return chosen.dropDuplicates(["doc_id", *hashes]).select("_row.*")
