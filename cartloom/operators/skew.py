"""Left joins that hold when one key carries a large share of a table's rows.

What a key costs a task is the product of its rows in the joined tables. Spark splits a
skewed partition at run time only on the outer side of a left join, and only where that
costs no further shuffle. A hot key on the inner side, or in a chain of joins on one key,
stays in one task, however many rows it makes. Here such keys are found first and their
rows laid out on a grid: a table's own rows of a hot key are dealt over n cells, the other
tables repeat theirs in each of them, and all join on key and cell. Each pair of rows
still meets in exactly one cell.

A key is hot if it makes more than CELL_ROWS joined rows; its cells then make about that
many each. One rule holds for every size of table and key and any length of id.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.plans.staging import stage

CELL_ROWS = 4_000_000  # joined rows of one key that one task takes in stride
BUCKET_ROWS = 64  # rows of the largest table per bucket of the search


@dataclass(frozen=True)
class HotKeys:
    """Cells per hot key and table: columns key, fan_<table>. `fans` is None if none is hot."""

    key: str
    tables: tuple[str, ...] = ()
    fans: DataFrame | None = None

    def salt(self, table: str) -> str:
        return f"_{self.key}_{table}_cell"

    def salts(self) -> list[str]:
        return [self.salt(t) for t in self.tables] if self.fans is not None else []


def joined_rows(tables) -> Column:
    """Rows a key makes, from its row counts in columns named like the tables."""
    counts = [F.greatest(F.col(t), F.lit(1)).cast("double") for t in tables]
    return reduce(lambda a, b: a * b, counts)


def cell_side(tables, cell_rows: int) -> Column:
    """The most rows a cell holds of each table, so that it makes some cell_rows.

    Tables with few rows leave more of the cell to the others, so the smallest count goes
    first: each takes at most an equal share, as a factor, of what is left.
    """
    counts = F.array_sort(F.array(*[F.greatest(F.col(t), F.lit(1)).cast("double") for t in tables]))
    left: Column = F.lit(float(cell_rows))
    for i in range(len(tables) - 1):
        share = F.pow(left, F.lit(1 / (len(tables) - i)))
        left = left / F.least(F.get(counts, i), share)
    return F.greatest(left, F.lit(1.0))


class SkewProfile:
    """Finds hot and repeated keys of cleaned frames, each at most once.

    `sources` are the frames before cleaning; their row counts bound the cleaned ones.
    """

    def __init__(
        self,
        sources: dict[str, DataFrame],
        clean: dict[str, DataFrame],
        cell_rows: int = CELL_ROWS,
    ):
        self.sources = sources
        self.clean = clean
        self.cell_rows = cell_rows
        self._rows: dict[str, int] = {}
        self._hot: dict[tuple, HotKeys] = {}
        self._repeated: dict[tuple, DataFrame | None] = {}

    def rows(self, *tables: str) -> dict[str, int]:
        """Row counts, all in one job; no column is read where the source is Parquet."""
        unknown = [t for t in tables if t not in self._rows]
        if unknown:
            marks = [self.sources[t].select(F.lit(t).alias("t")) for t in unknown]
            counts = reduce(DataFrame.unionAll, marks).groupBy("t").count().collect()
            self._rows |= dict.fromkeys(unknown, 0) | {r["t"]: r["count"] for r in counts}
        return {t: self._rows[t] for t in tables}

    def hot(self, key: str, *tables: str) -> HotKeys:
        """Keys that make more rows, joining the tables, than a task should."""
        if (key, *tables) not in self._hot:
            self._hot[(key, *tables)] = self._search(key, tables)
        return self._hot[(key, *tables)]

    def repeated(self, key: str, table: str) -> DataFrame | None:
        """Keys with several rows and how many (key, copies), or None if there are none."""
        if (key, table) not in self._repeated:
            counts = self.clean[table].groupBy(key).agg(F.count("*").alias("copies"))
            found = stage(counts.filter(F.col("copies") > 1), f"repeated-{key}")
            self._repeated[key, table] = None if found.isEmpty() else found
        return self._repeated[key, table]

    def _search(self, key, tables) -> HotKeys:
        rows = self.rows(*tables)
        most = reduce(lambda a, b: a * b, [max(n, 1) for n in rows.values()])
        if most <= self.cell_rows:  # all rows of all tables together make no more
            return HotKeys(key)
        keys = reduce(
            DataFrame.unionAll,
            [self.clean[t].select(F.col(key), F.lit(t).alias("t")) for t in tables],
        )
        counts = [F.count_if(F.col("t") == t).alias(t) for t in tables]
        crowded = joined_rows(tables) > self.cell_rows

        # A bucket of keys makes no fewer rows than a key in it. Counting by bucket shuffles
        # a few numbers, and only keys of crowded buckets have to be counted one by one.
        buckets = -(-max(rows.values()) // BUCKET_ROWS)
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")
        suspects = stage(
            keys.groupBy(bucket).agg(*counts).filter(crowded).select("bucket"), f"buckets-{key}"
        )
        if suspects.isEmpty():
            return HotKeys(key)
        per_key = (
            keys.withColumn("bucket", bucket)
            .join(suspects, "bucket", "left_semi")
            .groupBy(key)
            .agg(*counts)
            .filter(crowded)
        )
        side = cell_side(tables, self.cell_rows)
        fan = [F.greatest(F.ceil(F.col(t) / side), F.lit(1)).cast("int").alias(f"fan_{t}") for t in tables]
        fans = stage(per_key.select(key, *fan), f"hot-{key}")
        return HotKeys(key, tuple(tables), None if fans.isEmpty() else fans)


def spread(df: DataFrame, table: str | None, hot: HotKeys) -> DataFrame:
    """Add the cell columns: deal the table's own hot rows, repeat them along other axes.

    Rows are dealt by a hash of their position, so copies of one row part too, however
    files are laid out. Apply this to rows that come straight from files, whose order is
    the same when a task is rerun.
    """
    if hot.fans is None:
        return df
    kept = df.columns
    placed = df.withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
    out = placed.join(hot.fans, hot.key, "left")
    fan = {t: F.coalesce(F.col(f"fan_{t}"), F.lit(1)) for t in hot.tables}
    if table in fan:
        cell = F.pmod(F.col("_place"), fan[table].cast("long"))
        out = out.withColumn(hot.salt(table), cell.cast("int"))
    for t in hot.tables:
        if t != table:
            out = out.withColumn(hot.salt(t), F.explode(F.sequence(F.lit(0), fan[t] - 1)))
    split = [(fan[t] > 1).alias(_split(hot, t)) for t in hot.tables if t != table]
    return out.select(*kept, *hot.salts(), *split)


def _split(hot: HotKeys, table: str) -> str:
    return f"{hot.salt(table)}_split"


def left_join(
    base: DataFrame, sides: dict[str, DataFrame], hot: HotKeys, how: str = "left"
) -> DataFrame:
    """base joined to each side on hot.key. The base must have been spread with `hot`."""
    if hot.fans is None:
        for side in sides.values():
            base = merge(base, side, [hot.key], how)
        return base
    on = [hot.key, *hot.salts()]
    for table, side in sides.items():
        side = spread(side, table, hot)
        side = side.drop(*[_split(hot, t) for t in hot.tables])
        if table not in hot.tables:
            base = merge(base, side, on, how)
            continue
        # A hot key has rows in this table, so a cell that met none is only a repeat.
        hit = f"{hot.salt(table)}_hit"
        base = merge(base, side.withColumn(hit, F.lit(True)), on, how)
        base = base.filter(~F.col(_split(hot, table)) | F.col(hit)).drop(hit)
    return base.drop(*hot.salts(), *[_split(hot, t) for t in hot.tables])


def merge(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join on shared columns; other columns named alike get _x and _y."""
    shared = (set(left.columns) & set(right.columns)) - set(on)
    if shared:
        left = left.withColumnsRenamed({c: f"{c}_x" for c in shared})
        right = right.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return left.join(right, on, how)


