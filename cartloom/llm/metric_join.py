"""Exact near-duplicate join of vectors by pivots and the triangle inequality.

Unit vectors with cosine c are sqrt(2 - 2c) apart, so a cosine threshold is a radius.
Every vector belongs to the cell of its nearest pivot. It is copied to another cell only
where a vector of that cell may be within the radius: by the triangle inequality the
other pivot is no farther than that cell's reach plus the radius, and the vector is no
farther than the radius from the plane between the two pivots. Of two cells only the
lower-numbered one receives copies, so each pair of vectors meets once. Cells then join
on their own; large ones are cut into blocks, pairs of which are the tasks.

Equal vectors are one row from the start. A block sends on counts and one link per
vector, never its pairs.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.components import components
from cartloom.plans.staging import stage

MIN_COSINE = 0.9
BLOCK = 2048  # vectors of one side of a task
MAX_PIVOTS = 4096
SLACK = 1e-9  # for rounding, on the side of copying more


def _vectors(column) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Cells:
    """Pivots of one vector length, the reach of their cells and the radius."""

    def __init__(self, pivots: np.ndarray, radius: float, reach: np.ndarray | None = None):
        self.pivots, self.radius, self.reach = pivots, radius, reach
        gaps = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
        self.gaps = np.where(gaps > 0, gaps, np.inf)

    def home(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot, and all cosines to pivots."""
        cosines = units @ self.pivots.T
        return cosines.argmax(axis=1), cosines

    def copies(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """home, and (row, cell) of every copy that a lower cell needs."""
        home, cosines = self.home(units)
        own = cosines[np.arange(len(units)), home]
        # On the unit sphere the distance to the plane between two pivots is this.
        to_plane = (own[:, None] - cosines) / self.gaps[home]
        distance = np.sqrt(np.maximum(2 - 2 * cosines, 0))
        near = (to_plane <= self.radius + SLACK) & (distance <= self.reach + self.radius + SLACK)
        near &= np.arange(len(self.pivots)) < home[:, None]
        return (home, *np.nonzero(near))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of n nodes reaches over links a-b."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _join_block(group: pa.Table, cosine: float) -> pa.Table:
    """Links of the left rows among themselves (a diagonal block) or with the right ones."""
    right = group.column("right").to_numpy(zero_copy_only=False).astype(bool)
    units = _unit(_vectors(group.column("v").combine_chunks()))
    ids, copies = group.column("cid").to_numpy(), group.column("copies").to_numpy()
    left, other = np.flatnonzero(~right), np.flatnonzero(right)
    block = group.column("a")[0].as_py() == group.column("b")[0].as_py()
    if block:
        other = left
    links, ends = np.zeros(len(ids), np.int64), ([], [])
    for i in range(0, len(left), BLOCK):
        for j in range(0, len(other), BLOCK):
            x, y = left[i : i + BLOCK], other[j : j + BLOCK]
            p, q = np.nonzero(units[x] @ units[y].T >= cosine)
            p, q = x[p], y[q]
            p, q = (p[p != q], q[p != q]) if block else (p, q)
            np.add.at(links, p, copies[q])
            if not block:
                np.add.at(links, q, copies[p])
            ends[0].append(p)
            ends[1].append(q)
    linked = np.flatnonzero(links)
    both = [np.concatenate(e) if e else np.zeros(0, int) for e in ends]
    root = _forest(len(ids), *both)
    return pa.table({"cid": ids[linked], "links": links[linked], "root": ids[root[linked]]})


def near_vectors(
    vectors: DataFrame,
    cosine: float = MIN_COSINE,
    pivots: int | None = None,
    block: int = BLOCK,
    column: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors(vec_id, embedding).

    Links are pairs of rows with a cosine of at least `cosine` (over 0), in doubles; equal
    vectors link too. Null, empty and zero vectors and those with null or non-finite components
    link with nothing, nor do vectors of different lengths. n_links counts rows, so
    repeated rows count. Rows without vec_id take part; component_id is the smallest
    vec_id there is, null if there is none. Other columns are ignored.

    The driver holds the pivots, sqrt(rows) / 4 and at most MAX_PIVOTS vectors, and a few
    numbers per cell.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if dict(vectors.dtypes)[column] == "array<float>" else "array<double>"
    value = F.col(f"`{column}`").cast(kind)
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = (F.size(value) > 0) & ~odd
    sound = F.coalesce(sound & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(sound, value).alias("v"))
    classes = (
        rows.filter("v IS NOT NULL")
        .groupBy("v")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = stage(classes, "vectors")
    n = classes.count()
    wanted = pivots or min(MAX_PIVOTS, max(8, math.isqrt(n) // 4))
    chosen = classes.orderBy(F.xxhash64("v"), "cid").limit(wanted).select("v").collect()
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    by_length: dict[int, list] = {}
    for r in chosen:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    cells = {d: Cells(_unit(np.array(p, np.float64)), radius) for d, p in by_length.items()}
    whole = classes.select("cid", "copies", "v")

    def split(batch):
        """A batch's rows by vector length: (length, row numbers, unit vectors)."""
        lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            yield int(d), at, _unit(_vectors(batch.column("v").take(pa.array(at))))

    def reaches(batches):
        for batch in batches:
            for d, _, units in split(batch):
                if d in cells:
                    home, cosines = cells[d].home(units)
                    far = np.sqrt(np.maximum(2 - 2 * cosines[np.arange(len(units)), home], 0))
                    lengths = np.full(len(home), d, np.int32)
                    columns = {"d": lengths, "cell": home.astype(np.int32), "far": far}
                    yield pa.RecordBatch.from_pydict(columns)

    for d, c in cells.items():
        c.reach = np.zeros(len(c.pivots))
    far = whole.mapInArrow(reaches, "d int, cell int, far double")
    for r in far.groupBy("d", "cell").agg(F.max("far").alias("far")).collect():
        cells[r["d"]].reach[r["cell"]] = r["far"]

    def located(batch):
        """(length, rows, cells, whether a copy) of a batch's vectors and their copies.

        Vectors of a length without pivots are one cell."""
        for d, at, units in split(batch):
            if d not in cells:
                yield d, at, np.zeros(len(at), np.int64), np.zeros(len(at), bool)
                continue
            home, row, cell = cells[d].copies(units)
            yield d, at, home, np.zeros(len(at), bool)
            yield d, at[row], cell, np.ones(len(row), bool)

    def counted(batches):
        for batch in batches:
            for d, _, cell, copy in located(batch):
                found, n = np.unique(cell, return_counts=True)
                columns = {
                    "d": np.full(len(found), d, np.int32),
                    "cell": found.astype(np.int32),
                    "copy": np.full(len(found), bool(copy.any())),
                    "n": n,
                }
                yield pa.RecordBatch.from_pydict(columns)

    sizes = whole.mapInArrow(counted, "d int, cell int, copy boolean, n long")
    parts = {
        (r["d"], r["cell"], r["copy"]): -(-r["n"] // block)
        for r in sizes.groupBy("d", "cell", "copy").agg(F.sum("n").alias("n")).collect()
    }

    def tasks(batches):
        """Each row once per task (a, b): block a of a cell's own rows with its block b,
        where blocks of copies are numbered after the own ones."""
        names = ["d", "cell", "a", "b", "right", "cid", "copies", "v"]
        for batch in batches:
            cids = batch.column("cid").to_numpy()
            for d, at, cell, copy in located(batch):
                out = []
                for i, c, is_copy in zip(at.tolist(), cell.tolist(), copy.tolist(), strict=True):
                    own, others = parts.get((d, c, False), 0), parts.get((d, c, True), 0)
                    mix = int(cids[i]) * 0x9E3779B97F4A7C15 % 2**64 >> 33
                    if is_copy:
                        b = own + mix % others
                        out += [(c, a, b, True, i) for a in range(own)]
                    else:
                        me = mix % own
                        out += [(c, me, b, False, i) for b in range(me, own + others)]
                        out += [(c, a, me, True, i) for a in range(me)]
                for start in range(0, len(out), 20_000):
                    c, a, b, right, i = zip(*out[start : start + 20_000], strict=True)
                    taken = batch.take(pa.array(i))
                    columns = [pa.array(x, pa.int32()) for x in ([d] * len(c), c, a, b)]
                    columns += [pa.array(right), *(taken.column(x) for x in ("cid", "copies", "v"))]
                    yield pa.RecordBatch.from_arrays(columns, names)

    dealt = whole.mapInArrow(
        tasks, f"d int, cell int, a int, b int, right boolean, cid long, copies long, v {kind}"
    )
    found = dealt.groupBy("d", "cell", "a", "b").applyInArrow(
        lambda group: _join_block(group, cosine), "cid long, links long, root long"
    )
    found = stage(found, "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    placed = (
        classes.join(links, "cid", "left")
        .join(roots.select(F.col("id").alias("cid"), "root"), "cid", "left")
        .select(
            "v",
            "first",
            "copies",
            F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("root", "cid").alias("root"),
        )
    )
    placed = stage(placed, "placed")
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = placed.join(smallest, "root").select(
        "v", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    linked = rows.filter("v IS NOT NULL").join(of_class, "v")
    linked = linked.select("vec_id", "n_links", "component_id")
    alone = rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), sound AS (
  SELECT * FROM v WHERE len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
    ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    AND list_dot_product(x.e, y.e) >= {MIN_COSINE} * sqrt(list_dot_product(x.e, x.e))
      * sqrt(list_dot_product(y.e, y.e))
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), components AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""
