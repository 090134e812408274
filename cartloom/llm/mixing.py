"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is how many copies each of its documents should have on
average: a whole part and a fraction, the document's copy probability. Two partners move
words' worth of probability between them, in a random direction, until one of them is
integral. That keeps the source's words the same at every step and every document's
expectation.

Documents are dealt over lanes within their source. In a lane the largest open document is
paired with the pool of all smaller ones: it is taken or not, or some of the pool are. The
pool's members move along one direction, back or forth, so each keeps its own expectation,
whatever their probabilities. (Pairs of single documents would settle the smaller one each
time and leave the largest open.) What a lane leaves open is a small document; these
residuals meet in fewer lanes, and so on, until one per source is left to chance.

Rows that are equal in every column are one class. Of its n rows at a probability of p,
the whole part of np get a copy for certain, and its fraction is rounded like a residual.
"""

import random
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cartloom.llm.common import WORD, table
from cartloom.operators.rowids import number_rows
from cartloom.plans.staging import stage

WEIGHTS = (5, 2, 1)  # fixed values: by source in code point order, repeating
MAX_COPIES = 3  # fixed value
LANE_ROWS = 2000
FAN_IN = 1000  # lanes whose residuals meet in one lane of the next level
SEED = 11
CLOSE = 1e-12  # a probability this near to 0 or 1 is taken for it
REPEATS = 100_000  # rows of one class that one task writes


def source_plans(classes: DataFrame, weights, most: int, lane_rows: int) -> DataFrame:
    """(src, source_size, target, whole, p, lanes): a row per source, none on the driver.

    A target is the source's share of all words by weight, at most `most` times its size;
    the excess is shared again by weight until no share is above. Each round asks for
    three sums over the sources.
    """
    words = F.sum(F.col("size") * F.col("n")).alias("source_size")
    sums = classes.groupBy("src").agg(words, F.count("*").alias("rows"))
    placed = number_rows(sums.withColumn("void", F.col("src").isNull()), ["void", "src"], "place")
    turn = ((F.col("place") - 1) % len(weights) + 1).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)
    most_words = F.col("source_size").cast("double") * most
    sources = stage(placed.withColumns({"weight": weight, "limit": most_words}), "sources")
    total, parts = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    unit, capped = (total or 0) / (parts or 1), 0
    while True:
        over = F.col("weight") * unit > F.col("limit")
        limits, parts, n = sources.agg(
            F.sum(F.when(over, F.col("limit"))), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)
        ).first()
        if n == capped or not parts:
            break
        unit, capped = (total - limits) / parts, n
    target = F.when(over, F.col("limit")).otherwise(F.col("weight") * unit)
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor("mean"), F.lit(most)).cast("int")
    lanes = F.ceil(F.col("rows") / lane_rows)
    return (
        sources.withColumn("target", target)
        .withColumn("mean", mean)
        .select(
            F.col("src").alias("_src"), "source_size", "target", whole.alias("whole"),
            (F.col("mean") - whole).alias("p"), lanes.alias("lanes"),
        )
    )


def settle(sizes: np.ndarray, p: np.ndarray, rng: random.Random) -> np.ndarray:
    """Probabilities after pivotal moves, at most one of them still open; sizes descend.

    A move takes words from the pool for the document or the other way. The chance of
    either is the share of the other's way, and a member of the pool moves by the same
    share of the words both ways, so all expectations stay, and so does sizes @ p. A move
    ends where the document or a member is integral.
    """
    p = p.astype(float)
    void = sizes == 0
    p[void] = [rng.random() < x for x in p[void]]
    for k in range(len(p)):
        pool = k + 1 + np.flatnonzero((p[k + 1 :] > 0) & (p[k + 1 :] < 1))
        while len(pool) and 0 < p[k] < 1:
            open_, size = p[pool], sizes[k]
            room = np.minimum(open_, 1 - open_)
            way = room / (sizes[pool] @ room)
            up = min(size * (1 - p[k]), (open_ / way).min())
            down = min(size * p[k], ((1 - open_) / way).min())
            moved = up if rng.random() * (up + down) < down else -down
            changed = np.append(open_ - way * moved, p[k] + moved / size)
            changed[changed < CLOSE] = 0.0
            changed[changed > 1 - CLOSE] = 1.0
            p[pool], p[k] = changed[:-1], changed[-1]
            pool = pool[(changed[:-1] > 0) & (changed[:-1] < 1)]
    return p


def _settle(rows: DataFrame) -> DataFrame:
    """One level: rows(h, g, src, lane, size, p, u) plus copy, null for a lane's residual.

    A task holds one lane at a time, some `lane_rows` or FAN_IN rows of numbers.
    """
    schema = StructType([*rows.schema.fields, StructField("copy", IntegerType())])

    def run(lane: pa.Table) -> pa.Table:
        kinds = {"size": "descending", "u": "ascending", "h": "ascending", "g": "ascending"}
        lane = lane.sort_by(list(kinds.items()))
        sizes, p, u = (lane.column(c).to_numpy() for c in ("size", "p", "u"))
        p = settle(sizes, p, random.Random(float(u[0])))
        copies = pa.array([int(x) if x in (0.0, 1.0) else None for x in p], pa.int32())
        lane = lane.set_column(lane.column_names.index("p"), "p", pa.array(p))
        return lane.append_column("copy", copies)

    return rows.groupBy("src", "lane").applyInArrow(run, schema)


def _chance(*parts) -> Column:
    """A number from 0 up to 1, by a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _keys(docs: DataFrame) -> list[Column]:
    """Two hashes of a whole row, which tell nulls apart from columns that are not there."""
    parts = []
    for name, kind in docs.dtypes:
        value = F.col(f"`{name}`")
        parts.append(F.to_json(F.struct(value)) if "map<" in kind or "variant" in kind else value)
    parts.append(F.array(*[F.col(f"`{c}`").isNull() for c in docs.columns]))
    return [F.xxhash64(F.lit(SEED + i), *parts).alias(name) for i, name in enumerate("hg")]


def _numbered(rows: DataFrame) -> DataFrame:
    """Every row as often as its n says, with a number i from 0; n is at most REPEATS."""
    return rows.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most: int = MAX_COPIES,
    lane_rows: int = LANE_ROWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, size, source_size, target, copies) for every row of docs(text, source, ...).

    size is the number of words, a null or empty text having none; a null source is a
    source like any other and comes last. copies is 0 to `most`, and size * copies summed
    over a source is within one document of its target; a document's expected copies are
    its target over its size. Documents without words are copied by chance alone. The same
    rows give the same copies, in whatever order they are read; repeated rows share theirs,
    one more or less each. An empty table gives none. row holds the columns of docs, or
    those of `keep`, and may be named like the other results. docs are read twice and must be the
    same; a text longer than a row may be is Spark's limit, not one of this operator.

    Only a row's hashes, size and source go through the lanes. Texts, where row holds any,
    are shuffled once, to meet their copies.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    src = F.col("source").cast("string").alias("src")
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    marks = _keys(docs)
    classes = docs.select(src, size, *marks).groupBy("src", "size", "h", "g")
    classes = stage(classes.agg(F.count("*").alias("n")), "classes")
    plans = stage(source_plans(classes, weights, most, lane_rows), "plans")
    share = F.col("n") * F.col("p")
    rows = classes.join(plans, F.col("src").eqNullSafe(F.col("_src"))).select(
        "h", "g", "src", "n", "size", "source_size", "target", "lanes",
        (F.col("n") * F.col("whole") + F.floor(share)).alias("certain"),
        (share - F.floor(share)).alias("p"),
    )
    todo = rows.select(
        "h", "g", "src", F.pmod(F.xxhash64("h"), F.col("lanes")).alias("lane"), "size", "p",
        _chance(F.lit(SEED), "h", "g").alias("u"),
    )
    most_lanes = plans.agg(F.max("lanes")).first()[0] or 1
    level, settled = 0, []
    while True:
        out = stage(_settle(todo), f"mixed-{level}")
        settled.append(out.filter("copy IS NOT NULL").select("h", "g", "copy"))
        left = out.filter("copy IS NULL")
        if most_lanes <= FAN_IN**level:
            last = (_chance(F.lit(SEED), "u") < F.col("p")).cast("int").alias("copy")
            settled.append(left.select("h", "g", last))
            break
        lane = F.floor(F.col("lane") / FAN_IN)
        todo = left.drop("copy").withColumns({"lane": lane, "u": _chance(F.lit(level), "u", "h")})
        level += 1
    done = reduce(DataFrame.unionByName, settled)
    found = rows.join(done, ["h", "g"]).select(
        "h", "g", "n", "size", "source_size", "target",
        (F.col("certain") + F.col("copy")).alias("total"),
    )
    found = stage(found, "copies")
    told = docs.select(kept, *marks)
    few = found.filter(F.col("n") <= REPEATS)
    each = _numbered(told.groupBy("h", "g").agg(F.first("row").alias("row")).join(few, ["h", "g"]))
    many = found.filter(F.col("n") > REPEATS)
    if not many.isEmpty():  # classes of very many rows: their numbers are dealt in blocks
        ids = many.select("h", "g")
        one = told.join(ids, ["h", "g"], "left_semi").groupBy("h", "g").agg(F.first("row").alias("row"))
        block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / REPEATS)))
        dealt = one.join(many, ["h", "g"]).withColumn("block", block).repartition("h", "block")
        first = F.col("block") * REPEATS
        numbers = F.sequence(first, F.least(F.col("n"), first + REPEATS) - 1)
        each = each.unionByName(dealt.withColumn("i", F.explode(numbers)).drop("block"))
    copies = F.floor(F.col("total") / F.col("n")) + (F.col("i") < F.col("total") % F.col("n")).cast("int")
    return each.select("row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def op3_mixing_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mix(docs, keep=["doc_id"]).select("row.doc_id", "size", "source_size", "target", taken)


def mix_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it.

    Nulls, empty and very long texts, ties, repeated rows, empty tables and columns named
    like the operator's own are as in `mix`; the columns are those of docs.
    """
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return mix(docs).select("row", copies).select("row.*")
