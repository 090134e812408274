"""Best-fit packing of documents into sequences, with certified bin counts.

Every task packs the pieces it reads, lane by lane, best-fit decreasing, so that the ids of
most documents never leave the task that made them. Dual-feasible functions give a lower
bound for a lane's pieces; bins equal to the bound prove that no packing of the lane needs
fewer. Lanes with a gap give up the pieces of all their unfilled bins, the others those of
their emptiest bin. These pieces alone are dealt anew over lanes by a hash and packed
again, until the count meets the bound of these pieces, no longer falls, or ROUNDS are over.
"""

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.tokens import END_ID, Encoder, tokenizer_path
from cartloom.plans.staging import stage, staged_folder

CAPACITY = 2048
LANE_PIECES = 20_000
FILL_TOKENS = 8 << 20  # ids that a task holds while it packs its first lane of them
ROUNDS = 6
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def lower_bound(counts: np.ndarray) -> int:
    """Bins of capacity len(counts) - 1 that counts[x] pieces of each length x need at least.

    The largest of two families of dual-feasible functions: lengths under a go to 0 and
    those over capacity - a to the whole, for every a up to half; and lengths rounded
    down to k-ths, for small k.
    """
    capacity = len(counts) - 1
    counts = counts.astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(counts * sizes)])  # total[x]: of lengths under x
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # above[x]: lengths of x or more
    a = np.arange(0, capacity // 2 + 1)
    middle = total[capacity - a + 1] - total[a]
    best = int((-(-(middle + capacity * above[capacity - a + 1]) // capacity)).max())
    for k in range(1, 11):
        scaled = (k + 1) * sizes
        units = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * units).sum()) // (capacity * k)))
    return best


def best_fit(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the order given, and the bins' contents.

    A bit set tells which amounts of free space some bin has, so the tightest bin is the
    lowest set bit from the length on.
    """
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    have, used = 0, []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths):
        fits = have >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            at = free[space].pop()
            if not free[space]:
                have ^= 1 << space
        else:
            space, at = capacity, len(used)
            used.append(0)
        bins[i], offsets[i] = at, used[at]
        used[at] += n
        left = space - n
        if left:
            if not free[left]:
                have |= 1 << left
            free[left].append(at)
    return bins, offsets, np.array(used, np.int64)


def _loose(used: np.ndarray, bound: int, capacity: int) -> np.ndarray:
    """Which bins are given up: unfilled ones, of a certified lane the emptiest alone."""
    loose = used < capacity
    if len(used) == bound:
        loose = loose & (np.arange(len(used)) == used.argmin())
    return loose


def _cuts(n: int, capacity: int) -> list[int]:
    """Where n ids are cut; all pieces but the first are full."""
    return [0, *range(n % capacity or capacity, n + 1, capacity)]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and an end id,
    cut only where longer than capacity; then all pieces but the first are full.

    A null or empty text is the end id alone. Repeated rows give repeated pieces.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        encoder, end = Encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(doc_ids, batch.column("text"), strict=True):
                ids = encoder.ids(text.as_py()) + end
                cuts = _cuts(len(ids) // 4, capacity)
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[4 * a : 4 * b]
                    row = (doc_id, k, a, b - a, zlib.crc32(part))
                    out.append((*row, part) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, PIECE + ", ids binary" * with_ids)


def _pack_lanes(rows: DataFrame, lanes: int, turn: int, capacity: int) -> DataFrame:
    """Adds lane, bin, offset, lane_bins, lane_bound and loose, packing each lane alone."""
    lane = F.pmod(F.xxhash64(F.lit(turn), "uid"), F.lit(lanes)).cast("int").alias("lane")
    dealt = rows.select("uid", F.col("length").cast("int"), lane)
    dealt = dealt.repartition(lanes, "lane").sortWithinPartitions("lane", F.desc("length"), "uid")

    def pack(uid, length, at):
        bins, offsets, used = best_fit(length.tolist(), capacity)
        bound = lower_bound(np.bincount(length, minlength=capacity + 1))
        loose = _loose(used, bound, capacity)
        columns = {
            "uid": uid,
            "lane": np.full(len(uid), at, np.int32),
            "bin": bins.astype(np.int32),
            "offset": offsets,
            "lane_bins": np.full(len(uid), len(used), np.int32),
            "lane_bound": np.full(len(uid), bound, np.int32),
            "loose": loose[bins],
        }
        return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    def run(batches):
        # Rows come lane by lane; a lane is held whole and has some LANE_PIECES rows.
        held, current = [], None
        for batch in batches:
            uid, length, lane = (batch.column(c).to_numpy() for c in ("uid", "length", "lane"))
            cuts = [0, *(np.flatnonzero(np.diff(lane)) + 1).tolist(), len(lane)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and lane[a] != current:
                    yield pack(*(np.concatenate(x) for x in zip(*held, strict=True)), current)
                    held = []
                current = lane[a]
                held.append((uid[a:b], length[a:b]))
        if held:
            yield pack(*(np.concatenate(x) for x in zip(*held, strict=True)), current)

    placed = "uid long, lane int, bin int, offset long"
    return dealt.mapInArrow(run, f"{placed}, lane_bins int, lane_bound int, loose boolean")


def pack(items: DataFrame, capacity: int = CAPACITY, lane_pieces: int = LANE_PIECES) -> DataFrame:
    """items(length from 1 to capacity, ...) plus sequence_id and offset.

    Items of one sequence_id add up to capacity at most and lie gapless from offset 0.
    Reruns over the same rows agree. What reaches the driver are the counts per length,
    of which there are at most `capacity`, and sums.
    """
    kept = items.columns
    uid = F.monotonically_increasing_id().alias("uid")
    rows = stage(items.select(uid, F.struct("*").alias("row"), F.col("length")), "items")
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    bound, n = lower_bound(counts), int(counts.sum())
    todo, placed, settled, before = rows, [], 0, None
    for turn in range(ROUNDS):
        lanes = max(1, -(-n // lane_pieces))
        out = stage(_pack_lanes(todo, lanes, turn, capacity), f"packed-{turn}")
        per_bin = out.groupBy("lane", "bin").agg(F.max("loose").alias("loose"))
        bins, loose = per_bin.agg(F.count("*"), F.count_if("loose")).first()
        if before is not None and bins >= before[1]:
            break  # the former packing of these pieces was better; it stands below
        number = F.col("lane").cast("long") * (1 << 28) + F.col("bin") + F.lit(turn << 52)
        out = out.select("uid", number.alias("sequence_id"), "offset", "loose")
        if before is not None:
            placed[-1] = placed[-1].filter("NOT loose")
        placed.append(out)
        settled += bins if before is None else bins - before[1]
        if settled <= bound or lanes == 1 or not loose:
            break
        before = (turn, loose)
        todo = rows.join(out.filter("loose").select("uid"), "uid", "left_semi")
        n = out.filter("loose").count()
    plan = placed[0]
    for part in placed[1:]:
        plan = plan.unionByName(part)
    return rows.join(plan.drop("loose"), "uid").select(
        *[F.col("row")[c].alias(c) for c in kept], "sequence_id", "offset"
    )


LISTS = ["doc_id", "piece", "start", "length"]  # of a sequence's pieces, in their order
SEQUENCE = "sequence_id long, ids binary, doc_id array<long>, piece array<int>, start array<long>, length array<long>"
SEQUENCE_TYPES = [pa.int64(), pa.binary(), *(pa.list_(pa.int32() if c == "piece" else pa.int64()) for c in LISTS)]
SEQUENCE_NAMES = ["sequence_id", "ids", *LISTS]


def fill(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    fill_tokens: int = FILL_TOKENS,
) -> DataFrame:
    """(SEQUENCE, loose): all documents' pieces in sequences of the task that reads them.

    A task holds a lane of fill_tokens ids and one document at most. Sequence numbers are
    below 0 and follow from the partition, so a task that runs again makes the same ones.
    """

    def run(batches):
        from pyspark import TaskContext

        encoder, end = Encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        number, held, size = -1 - (TaskContext.get().partitionId() << 33), [], 0

        def lane():
            nonlocal number
            held.sort(key=lambda piece: -piece[3])  # ties in reading order
            lengths = [piece[3] for piece in held]
            bins, _, used = best_fit(lengths, capacity)
            bound = lower_bound(np.bincount(lengths, minlength=capacity + 1))
            inside: list[list] = [[] for _ in used]
            for piece, at in zip(held, bins.tolist(), strict=True):
                inside[at].append(piece)
            held.clear()
            loose = _loose(used, bound, capacity)
            for a in range(0, len(inside), 256):
                out = []
                for found in inside[a : a + 256]:
                    *traits, parts = zip(*found, strict=True)
                    out.append((number, b"".join(parts), *map(list, traits)))
                    number -= 1
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), SEQUENCE_TYPES, strict=True)]
                columns.append(pa.array(loose[a : a + 256]))
                yield pa.RecordBatch.from_arrays(columns, [*SEQUENCE_NAMES, "loose"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py()) + end
                cuts = _cuts(len(ids) // 4, capacity)
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    held.append((doc_id, k, a, b - a, ids[4 * a : 4 * b]))
                size += len(ids) // 4
                if size >= fill_tokens:
                    yield from lane()
                    size = 0
        if held:
            yield from lane()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"{SEQUENCE}, loose boolean")


def sequences(packed: DataFrame) -> DataFrame:
    """(SEQUENCE): a sequence's ids in one string, and a list of each trait of its pieces."""
    rows = packed.select("sequence_id", "offset", *LISTS, "ids").repartition("sequence_id")

    def run(batches):
        # Rows come sequence by sequence; one, bounded by capacity, is open at a time.
        current, parts, traits, done = None, [], [[] for _ in LISTS], []

        def emit():
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), SEQUENCE_TYPES, strict=True)]
            return pa.RecordBatch.from_arrays(columns, SEQUENCE_NAMES)

        for batch in batches:
            numbers = batch.column("sequence_id").to_pylist()
            found = zip(*(batch.column(c).to_pylist() for c in LISTS), strict=True)
            for number, row, ids in zip(numbers, found, batch.column("ids"), strict=True):
                if number != current:
                    if parts:
                        done.append((current, b"".join(parts), *traits))
                    current, parts, traits = number, [], [[] for _ in LISTS]
                parts.append(ids.as_py())
                for held, value in zip(traits, row, strict=True):
                    held.append(value)
            if done:
                yield emit()
                done = []
        if parts:
            done.append((current, b"".join(parts), *traits))
            yield emit()

    return rows.sortWithinPartitions("sequence_id", "offset").mapInArrow(run, SEQUENCE)


def cut(found: DataFrame, with_ids: bool = False) -> DataFrame:
    """The pieces of sequences, (PIECE[, ids], sequence_id, offset), from what lies in them."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset"]

    def run(batches):
        types = {"piece": pa.int32(), "ids": pa.binary()}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at = 0
                for d, k, a, n in zip(row["doc_id"], row["piece"], row["start"], row["length"], strict=True):
                    part = row["ids"][4 * at : 4 * (at + n)]
                    if len(part) != 4 * n:
                        raise ValueError(f"sequence {row['sequence_id']} lacks ids")
                    out.append((d, k, a, n, zlib.crc32(part), *[part] * with_ids, row["sequence_id"], at))
                    at += n
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            arrays = [pa.array(c, types.get(x, pa.int64())) for c, x in zip(columns, names, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return found.mapInArrow(run, PIECE + ", ids binary" * with_ids + ", sequence_id long, offset long")


def written(docs: DataFrame, folder: str, capacity: int = CAPACITY, fill_tokens: int = FILL_TOKENS) -> DataFrame:
    """The documents' sequences (SEQUENCE), written to a folder and read back.

    A null or empty text is the end id alone; of a very long one every piece but the first
    fills a sequence. Repeated rows are packed repeatedly, an empty table gives no
    sequences, other columns are ignored, whatever their names. Ties of length are packed
    in reading order, and by a hash of their number where they are dealt anew.
    """
    spark = docs.sparkSession
    filled = fill(docs, tokenizer_path(), capacity, fill_tokens=fill_tokens)
    filled.write.option("compression", "zstd").parquet(f"{folder}/filled")
    found = spark.read.schema(filled.schema).parquet(f"{folder}/filled")
    again = pack(cut(found.filter("loose"), with_ids=True).drop("sequence_id", "offset"), capacity)
    rest = sequences(again)
    rest.write.option("compression", "zstd").parquet(f"{folder}/rest")
    rest = spark.read.schema(rest.schema).parquet(f"{folder}/rest")
    return found.filter("NOT loose").drop("loose").unionByName(rest)


def op5_best_fit_packing(spark, sf_dir):
    """The pieces of all documents, taken from the written sequences; odd rows as written() says."""
    folder = f"{staged_folder(spark)}/sequences-{uuid.uuid4().hex}"
    return cut(written(table(spark, sf_dir, "documents"), folder))


def pack_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents, ids and all, with their place in a
    sequence; odd rows as written() says."""
    folder = f"{staged_folder(spark)}/sequences-{uuid.uuid4().hex}"
    return cut(written(docs, folder), with_ids=True)
