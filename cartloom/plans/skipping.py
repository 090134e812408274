"""Tables laid out so that lookups by any of several columns read few row groups.

Rows are sorted along a space-filling curve over the columns: each is cut into ranges of
about equal numbers of rows, and the bits of the range numbers are interleaved. So every
row group spans narrow ranges of all of them, which its statistics tell, and Bloom filters
tell the values inside. Spark's reader uses both when a filter is pushed down.
"""

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8  # of each column's range number
PREFIX = 7  # letters that fit a long in order
ROW_GROUP_BYTES = 32 << 20
PART_ROWS = 500_000  # rows of a written part


def _ordered(column: str, skipped: int) -> Column:
    """A long in the order of the texts, by PREFIX bytes after those that all have alike."""
    data = F.substring(F.col(column).cast("string").cast("binary"), skipped + 1, PREFIX)
    number = F.coalesce(F.conv(F.hex(data), 16, 10).cast("long"), F.when(data.isNotNull(), 0))
    return number * F.get(_literals([256 ** (PREFIX - n) for n in range(PREFIX + 1)]), F.octet_length(data))


def _literals(values: list) -> Column:
    """An array of longs or of texts given as bytes, made in one call."""
    return F.expr(f"array({', '.join(map(_sql, values))})")


def _sql(value: int | bytes) -> str:
    return f"cast(X'{value.hex()}' AS string)" if isinstance(value, bytes) else f"{value}L"


def _common(low: bytes, high: bytes) -> int:
    """Bytes that the least and the greatest text, so all between, begin with alike."""
    pairs = zip(low, high, strict=False)
    return next((i for i, (x, y) in enumerate(pairs) if x != y), min(len(low), len(high)))


def _range_number(value: Column, bounds: list[int]) -> Column:
    """How many bounds are not above the value; 0 for null. A value that spans several
    ranges has all their bounds, so that numbers use all BITS."""
    cuts = F.array(*[F.lit(x).cast("long") for x in bounds])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(BITS))])

    def search(v):  # the value is computed once
        reached = lambda n, step: F.coalesce(F.get(cuts, n + step - 1) <= v, F.lit(False))
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(reached(n, step), n + step).otherwise(n))

    return F.element_at(F.transform(F.array(value), search), 1)


def _spread(number: Column, i: int, columns: int) -> Column:
    """The number's bits at every columns-th place from i on."""
    out: Column = F.lit(0).cast("long")
    for bit in range(BITS):
        one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
        out = out.bitwiseOR(F.shiftleft(one, bit * columns + i))
    return out


@dataclass(frozen=True)
class Ranges:
    """The rows of a frame and, of each column, what all its texts begin with and the bounds
    of its ranges, as _ordered numbers."""

    rows: int
    columns: list[str]
    begins: list[bytes]
    bounds: list[list[int]]

    @classmethod
    def of(cls, df: DataFrame, columns: list[str]) -> "Ranges":
        """The driver sees 2^BITS bounds a column."""
        texts = [F.col(c).cast("string") for c in columns]
        found = df.agg(F.count("*"), *[f(t).cast("binary") for t in texts for f in (F.min, F.max)]).first()
        ends = [bytes(x or b"") for x in found[1:]]
        begins = [low[: _common(low, high)] for low, high in zip(ends[::2], ends[1::2], strict=True)]
        names = {f"_{i}": _ordered(c, len(b)) for i, (c, b) in enumerate(zip(columns, begins, strict=True))}
        values = df.select(*[value.alias(name) for name, value in names.items()])
        bounds = values.agg(*[F.percentile_approx(name, _shares(1 << BITS), 10_000) for name in names]).first()
        return cls(found[0], columns, begins, [list(b or []) for b in bounds])

    def texts(self, i: int) -> list[bytes]:
        """The bounds of a column as the least texts that reach them."""
        return [self.begins[i] + b.to_bytes(PREFIX, "big").rstrip(b"\0") for b in self.bounds[i]]


def _shares(ranges: int) -> list[float]:
    return [k / ranges for k in range(1, ranges)]


def curve(df: DataFrame, columns: list[str]) -> Column:
    """A row's place on the curve as one expression, for small tables. Nulls come first."""
    ranges = Ranges.of(df, columns)
    values = [_ordered(c, len(b)) for c, b in zip(columns, ranges.begins, strict=True)]
    place: Column = F.lit(0).cast("long")

    def spread(i):
        return lambda n: _spread(n, i, len(columns))

    for i, (value, cuts) in enumerate(zip(values, ranges.bounds, strict=True)):
        number = F.array(_range_number(value, cuts))
        parts = F.transform(number, spread(i))
        place = place.bitwiseOR(F.element_at(parts, 1))
    return place


def _with_numbers(df: DataFrame, values: dict[str, tuple[Column, list]]) -> DataFrame:
    """Columns that tell how many bounds are not above a value, 0 for null.

    A step of the binary search is a projection of its own, so that each is plain compiled
    code and no number is computed twice.
    """
    df = df.withColumns({name: F.lit(0) for name in values})
    arrays = {name: _literals(bounds) for name, (_, bounds) in values.items() if bounds}
    for bit in reversed(range(max(len(bounds).bit_length() for _, bounds in values.values()))):
        step = 1 << bit
        df = df.withColumns(
            {
                name: F.col(name) + F.when(F.get(cuts, F.col(name) + (step - 1)) <= values[name][0], step).otherwise(0)
                for name, cuts in arrays.items()
            }
        )
    return df


def with_place(df: DataFrame, ranges: Ranges) -> DataFrame:
    """The frame and `_place`, the number of curve(). Texts are compared with the bounds as they are."""
    columns = ranges.columns
    names = {f"_place_{i}": (F.col(c).cast("string"), ranges.texts(i)) for i, c in enumerate(columns)}
    place: Column = F.lit(0).cast("long")
    for i, name in enumerate(names):
        bits = [sum((n >> b & 1) << (b * len(columns) + i) for b in range(BITS)) for n in range(1 << BITS)]
        place = place.bitwiseOR(F.get(_literals(bits), F.col(name)))
    return _with_numbers(df, names).withColumn("_place", place).drop(*names)


def _with_part(placed: DataFrame, bounds: list[int]) -> DataFrame:
    """The frame and `_place_part`, its range of places. A place that spans several ranges is dealt
    over them by a hash of the row, so that only copies of whole rows stay together."""
    if not bounds:
        return placed.withColumn("_place_part", F.lit(0))
    place, high = F.col("_place"), F.col("_place_high")
    first = [bisect_left(bounds, b) for b in bounds]  # the range of places from there on, as a first one
    numbered = _with_numbers(placed, {"_place_high": (place, bounds)})
    low = F.when(F.get(_literals(bounds), high - 1) == place, F.get(_literals(first), high - 1).cast("int")).otherwise(high)
    dealt = F.pmod(F.xxhash64(*placed.columns), high - low + 1).cast("int")
    part = F.when(low < high, low + dealt).otherwise(high)
    return numbered.withColumn("_place_part", part).drop("_place_high")


def write_skipping(df: DataFrame, columns: list[str], path: str, row_group: int = ROW_GROUP_BYTES) -> DataFrame:
    """Write the rows in the order of the curve, with Bloom filters on the columns.

    The columns are read three times, for the ends, the bounds and the ranges of places that
    make a part each; whole rows are read once. Copies of one value lie on one place of the
    curve, and a place of many rows is dealt over several parts.
    """
    ranges = Ranges.of(df, columns)
    places = with_place(df.select(*columns), ranges)
    parts = max(-(-ranges.rows // PART_ROWS), 1)
    bounds = []
    if parts > 1:
        accuracy = max(10_000, 20 * parts)
        bounds = places.agg(F.percentile_approx("_place", _shares(parts), accuracy)).first()[0]
    order = ["_place", *columns, *[c for c in df.columns if c not in columns]]
    dealt = _with_part(with_place(df, ranges), bounds).repartitionById(parts, F.col("_place_part"))
    rows = dealt.sortWithinPartitions(*order).drop("_place", "_place_part")
    writer = rows.write.option("parquet.block.size", row_group)
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
