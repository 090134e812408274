"""Periodic runs in texts, by constant-time longest common extensions over suffix trees.

A run is a stretch of words that repeats with some period and cannot be extended. Every
run holds a Lyndon word of the length of its period that is, under one of two opposite
orders of the words, the longest Lyndon word at its place. So one candidate for each place
and order is enough: it is extended to the right and to the left by the longest common
extension of two suffixes, the depth of their lowest common ancestor in a suffix tree of
the stretch, or of its reversal.

Runs that count are so long that their words lie in windows of WINDOW words that stand in
the text twice. Trees are grown over the stretches such windows cover, which hold every
run whole.
"""

import zlib
from itertools import cycle, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import let, table

MIN_WORDS, MIN_EXPONENT = 24, 3
MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 16  # of the tour, whose minima make the table of ranges
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class SuffixTree:
    """Ukkonen's tree of a list of numbers from 1 on, closed by 0, with its Euler tour."""

    def __init__(self, values: list[int]):
        s = [*values, 0]
        self.n, base = len(s), max(s) + 1
        first, stop, link, to, leaves = [0], [0], [0], {}, []
        node = length = at = open_ = 0
        for i, c in enumerate(s):
            open_ += 1
            unlinked = 0
            while open_:
                if not length:
                    at = i
                key = node * base + s[at]
                child = to.get(key)
                if child is None:
                    to[key] = leaf = len(first)
                    leaves.append(leaf)
                    first.append(i), stop.append(self.n), link.append(0)
                    if unlinked:
                        link[unlinked] = node
                    unlinked = 0
                else:
                    begin = first[child]
                    size = stop[child] - begin
                    if length >= size:  # the active place lies beyond this edge
                        at, length, node = at + size, length - size, child
                        continue
                    if s[begin + length] == c:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    to[key] = middle = len(first)
                    first.append(begin), stop.append(begin + length), link.append(0)
                    first[child] = begin + length
                    to[middle * base + s[begin + length]] = child
                    to[middle * base + c] = leaf = len(first)
                    leaves.append(leaf)
                    first.append(i), stop.append(self.n), link.append(0)
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                open_ -= 1
                if not node and length:
                    length -= 1
                    at = i - open_ + 1
                elif node:
                    node = link[node]
        self._tour(np.array(first), np.array(stop), to, base, np.array(leaves))

    def _tour(self, first, stop, to, base, leaves) -> None:
        keys = np.fromiter(to.keys(), np.int64, len(to))
        order = np.argsort(keys)  # by parent, then by the word an edge begins with
        children = np.fromiter(to.values(), np.int64, len(to))[order].tolist()
        begins = np.searchsorted(keys[order], np.arange(len(first) + 1) * base).tolist()
        size = (stop - first).tolist()
        at, ends = begins[:-1], begins[1:]
        depth, tour, above, node = [0] * len(first), [], [], 0
        while True:
            tour.append(node)
            if at[node] < ends[node]:
                child = children[at[node]]
                at[node] += 1
                depth[child] = depth[node] + size[child]
                above.append(node)
                node = child
            elif above:
                node = above.pop()
            else:
                break
        tour = np.array(tour)
        place = np.empty(len(first), np.int64)
        place[tour] = np.arange(len(tour))
        self.place = place[leaves]  # where the tour meets each suffix, in order of suffixes
        blocks = -(-len(tour) // BLOCK)
        depths = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        depths[: len(tour)] = np.array(depth, np.int32)[tour]
        self.rows = depths.reshape(blocks, BLOCK)
        self.since = np.minimum.accumulate(self.rows, axis=1)
        self.until = np.minimum.accumulate(self.rows[:, ::-1], axis=1)[:, ::-1]
        self.levels = [self.rows.min(axis=1)]
        while (step := 1 << len(self.levels)) <= blocks:
            below = self.levels[-1]
            self.levels.append(np.minimum(below[: -(step >> 1)], below[step >> 1 :]))

    def ranks(self) -> list[int]:
        """Of each suffix, in order of words."""
        return self.place.tolist()

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j, which differ.

        The least depth on the tour between two leaves is that of their lowest common
        ancestor: two ends of blocks and two overlapping ranges of whole blocks tell it.
        """
        a, b = np.sort(np.stack([self.place[i], self.place[j]]), axis=0)
        x, y = a // BLOCK, b // BLOCK
        out = np.minimum(self.until[x, a % BLOCK], self.since[y, b % BLOCK])
        same = np.flatnonzero(x == y)
        column = np.arange(BLOCK)
        inside = (column >= (a[same] % BLOCK)[:, None]) & (column <= (b[same] % BLOCK)[:, None])
        out[same] = np.where(inside, self.rows[x[same]], np.iinfo(np.int32).max).min(axis=1)
        between = y - x - 1
        level = np.frexp(np.maximum(between, 1))[1] - 1
        for k in np.unique(level[between > 0]):
            at = np.flatnonzero((between > 0) & (level == k))
            low, high = self.levels[k][x[at] + 1], self.levels[k][y[at] - (1 << int(k))]
            out[at] = np.minimum(out[at], np.minimum(low, high))
        return out.astype(np.int64)


def _next(ranks: list[int], smaller: bool) -> np.ndarray:
    """The next place of smaller, or greater, rank; the end where there is none."""
    n = len(ranks)
    out, waiting = [n] * n, []
    values = ranks if smaller else [-r for r in ranks]
    for i, r in enumerate(values):
        while waiting and values[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return np.array(out)


def _runs_within(values: np.ndarray, min_words: int, min_exponent: int) -> np.ndarray:
    """Rows (start, length, period) of a stretch of numbers from 1 on."""
    n = len(values)
    forwards, backwards = SuffixTree(values.tolist()), SuffixTree(values[::-1].tolist())
    ranks = forwards.ranks()
    starts = np.tile(np.arange(n), 2)
    after = np.concatenate([_next(ranks, True)[:n], _next(ranks, False)[:n]])
    known = after <= n - 1  # a second period begins inside the stretch
    i, p = starts[known], (after - starts)[known]
    begin = i - backwards.common(n - i, n - i - p)
    end = i + p + forwards.common(i, i + p)
    good = end - begin >= np.maximum(min_words, min_exponent * p)
    found = np.stack([begin, end - begin, p], axis=1)[good]
    return np.unique(found, axis=0) if len(found) else found


def runs(values: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period), by start and period, of all runs of the numbers >= 0
    that have min_words words and min_exponent periods at least (2 or more).

    A run of length n >= min_exponent * q agrees with itself q words on over at least
    n - n / min_exponent words, so its words lie in windows of that size that stand twice.
    """
    window = max(1, min_words - min_words // min_exponent)
    none = np.empty((0, 3), np.int64)
    if len(values) < max(min_words, min_exponent):
        return none
    h, width = values.astype(np.uint64), 1
    while width < window:
        step = min(width, window - width)
        mixed = h * MIX
        mixed ^= mixed >> np.uint64(29)
        h = mixed[: len(h) - step] * MIX + h[step:]
        width += step
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return none
    at = np.flatnonzero(np.isin(h, twice))
    cuts = np.flatnonzero(np.diff(at) > window) + 1
    out = []
    for part in np.split(at, cuts):
        a, b = int(part[0]), int(part[-1]) + window
        _, local = np.unique(values[a:b], return_inverse=True)
        found = _runs_within(local + 1, min_words, min_exponent)
        found[:, 0] += a
        out.append(found)
    return np.concatenate(out)


def planted(doc_id: int, words: list[bytes]) -> list[bytes]:
    """The words, the end of every tenth text being made periodic, as the contract asks."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + list(islice(cycle(words[a : a + p]), n - a))


def periodic_runs(
    docs: DataFrame, change=None, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of docs(doc_id, text).

    runs are (start, length, period) in words, by start and period; collapsed is the text's
    words joined by one blank, without those that any run holds after its first period.
    change(doc_id, words), where given, turns the words into others first; a row without
    doc_id is left as it is. A null or empty text has no runs and collapses to an empty
    text; texts are read whole, however long; repeated rows return repeated; other columns
    are ignored, whatever their names.
    """

    def one(doc_id, text):
        words = text.encode().split()  # at ASCII white space only
        if change is not None and doc_id is not None:
            words = change(doc_id, words)
        ids: dict[bytes, int] = {}
        values = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
        found = runs(values, min_words, min_exponent)
        if len(found):
            ends = np.zeros(len(words) + 1, np.int64)
            np.add.at(ends, found[:, 0] + found[:, 2], 1)
            np.add.at(ends, found[:, 0] + found[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(ends[:-1]) == 0)]
        return found, b" ".join(words).decode()

    def run(batches):
        names = ("start", "length", "period")
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            made = [one(d, t.as_py() or "") for d, t in zip(doc_ids, batch.column(1), strict=True)]
            found = [[dict(zip(names, r, strict=True)) for r in rows.tolist()] for rows, _ in made]
            kind = pa.list_(pa.struct([(x, pa.int64()) for x in names]))
            columns = [batch.column(0), pa.array(found, kind), pa.array([t for _, t in made], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def op12_periodic_runs(spark, sf_dir):
    """Digests of periodic_runs() over all documents, every tenth made periodic at its end.

    Nulls, odd texts, repeated rows and empty tables: as periodic_runs() says; a text
    without runs has nulls for its greatest run.
    """
    rows = periodic_runs(table(spark, sf_dir, "documents"), planted)

    def greater(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    top = F.aggregate("runs", F.lit(None).cast(RUNS[6:-1]), greater)
    return rows.select("doc_id", "runs", "collapsed", let(top, lambda x: x).alias("top")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
