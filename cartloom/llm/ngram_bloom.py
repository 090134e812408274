"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts are quantised to levels. An n-gram of level q is entered q times, once with each
number from 1 to q, so asking for 1, 2, 3, ... until one is missing gives its level: never
too low, and too high by chance ever more rarely. The filter is cut into segments by the
n-gram's hash. Each is built by one task and sized by its own entries; their number grows
with the training tokens. Texts are read once, into chunks of whole documents that are
written with every word once. A chunk sends each of its distinct n-grams once, hash and
training count, to its segment. While filter and word counts are sure to be small, the
written segments are broadcast; beyond that bound the task that built a segment answers the
chunks that sent it n-grams, with equal results.

Probabilities are smoothed with the shorter context's, P(w|h) = (c(hw) + m P(w|h')) /
(c(h) + m); without context P(w) = (c(w) + 1) / (N + V + 1).
"""

import uuid
import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.token_files import file_system
from cartloom.plans.staging import stage, staged_folder

ORDER = 2  # words of an n-gram
SMOOTHING = 20.0  # m
BITS, PROBES = 7.2, 5  # bits of the filter an entry gets and sets: 3 % of strange entries seem known
BASE = 1.25  # levels beyond the first few grow by this factor
SEGMENT_TOKENS = 1 << 20  # training tokens a segment holds the n-grams of
BROADCAST_BYTES = 192 << 20  # filter and word counts, together, that may be broadcast
GROUP_TOKENS = 1 << 20  # tokens of a chunk
TOKEN_BYTES = 16  # a chunk of longer words than that on average is closed by its bytes
TASK_CHUNKS, TASK_SEGMENTS = 4, 2  # chunks and segments that one task works on, one after another
PROBED_ROWS = 1_000_000  # n-grams looked up at once
END, BEGIN = b"\n", b"\n\n"  # no words: these hold white space
U = np.uint64


def levels(most: int = 1 << 62) -> np.ndarray:
    """The least count of each level, from 1 on."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * BASE))))
    return np.array(out, np.int64)


LEVELS = levels()
#: What a level counts as, by its number: the middle of its counts; 0 for none.
COUNTS = np.concatenate([[0], (LEVELS[:-1] + LEVELS[1:] - 1) / 2])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(before * U(0x9E3779B97F4A7C15) + word)


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]  # A to Z, and ASCII white space, alone


def in_training(doc_id) -> bool:
    """The contract's split; a row without doc_id is held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def _planes(values: np.ndarray) -> bytes:
    """Unsigned integers as their lowest bytes, then the next ones, as far as any is not 0."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _values(data, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    planes = np.frombuffer(data, np.uint8).reshape(-1, max(size, 1))
    out[:, : len(planes)] = planes[:, :size].T
    return out.view("<u8").reshape(-1)


@dataclass(frozen=True)
class Chunk:
    """Whole documents, some GROUP_TOKENS tokens: each word once, and which word a token is."""

    ids: list  # doc_ids
    lengths: np.ndarray  # tokens of each document
    words: pa.Array
    at: np.ndarray  # a token's place in words

    def write(self, out) -> None:
        arrays = {
            "id": pa.array([self.ids], pa.list_(pa.int64())),
            "length": pa.array([self.lengths], pa.list_(pa.int64())),
            "word": pa.LargeListArray.from_arrays([0, len(self.words)], self.words),
            "at": pa.array([_planes(self.at)], pa.large_binary()),
        }
        batch = pa.RecordBatch.from_pydict(arrays)
        with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)

    @classmethod
    def read(cls, source) -> "Chunk":
        with pa.ipc.open_stream(source) as stream:
            row = stream.read_next_batch()
        lengths = row.column("length").flatten().to_numpy()
        at = _values(row.column("at")[0].as_buffer(), int(lengths.sum())).astype(np.int64)
        return cls(row.column("id").flatten().to_pylist(), lengths, row.column("word").flatten(), at)

    def trained(self) -> np.ndarray:
        return np.array([in_training(d) for d in self.ids], bool)

    def word_counts(self) -> np.ndarray:
        """Of each word, in training documents."""
        return np.bincount(self.at[np.repeat(self.trained(), self.lengths)], minlength=len(self.words))

    def whole_lengths(self, order: int) -> np.ndarray:
        """Of the documents with the order - 1 beginnings that each is given."""
        return self.lengths + (order - 1)

    def grams(self, seed: int, order: int):
        """For 1 to order words: the distinct n-grams' sorted keys, how often each is in
        training documents, and at each place of the documents, beginnings included, which
        of the keys ends there. Places without a whole n-gram show any."""
        lengths = self.whole_lengths(order)
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        trained = np.repeat(self.trained(), lengths)
        word = np.full(len(inside), len(self.words))
        word[inside >= order - 1] = self.at
        found = [xxhash.xxh3_64_intdigest(w, seed) for w in [*self.words.to_pylist(), BEGIN]]
        hashes = np.array(found, np.uint64)
        once, of = np.unique(_mix(hashes), return_inverse=True)
        at = of[word]
        yield once, np.bincount(at[trained], minlength=len(once)), at
        hashes = hashes[word]
        key = _mix(hashes)
        for k in range(1, order):
            key = _joined(np.concatenate([key[:1], key[:-1]]), hashes)
            whole = inside >= k
            once, of = np.unique(key[whole], return_inverse=True)
            at = np.zeros(len(key), np.int64)
            at[whole] = of
            yield once, np.bincount(of[trained[whole]], minlength=len(once)), at


def _chunks(batches):
    def numbered():
        return defaultdict(count().__next__)

    number, ids, at, held, size = numbered(), [], [], 0, 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = tokens(text.as_py())
            ids.append(doc_id)
            at.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)))
            held, size = held + len(found), size + sum(map(len, found))
            if held >= GROUP_TOKENS or size >= GROUP_TOKENS * TOKEN_BYTES:
                yield Chunk(ids, np.array([*map(len, at)]), pa.array(number, pa.large_binary()), np.concatenate(at))
                number, ids, at, held, size = numbered(), [], [], 0, 0
    if ids:
        yield Chunk(ids, np.array([*map(len, at)]), pa.array(number, pa.large_binary()), np.concatenate(at))


@dataclass(frozen=True)
class Chunks:
    """Written chunks, named by numbers."""

    folder: str
    names: DataFrame  # (chunk)
    tasks: int  # that are to read them

    @classmethod
    def of(cls, docs: DataFrame) -> "Chunks":
        """Of the documents. Only what succeeding tasks wrote is named, each by its own name."""
        spark = docs.sparkSession
        folder = f"{staged_folder(spark)}/chunk-files-{uuid.uuid4().hex}"

        def run(batches):
            from pyspark import TaskContext

            store, base = file_system(folder)
            store.create_dir(base, recursive=True)
            for number, chunk in enumerate(_chunks(batches)):
                name = TaskContext.get().taskAttemptId() << 24 | number
                with store.open_output_stream(f"{base}/{name}") as out:
                    chunk.write(out)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([name], pa.int64())})

        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        names = stage(rows.mapInArrow(run, "chunk long"), "chunks")
        n = names.count()
        return cls(folder, names, max(1, -(-n // TASK_CHUNKS), min(n, spark.sparkContext.defaultParallelism)))

    def reader(self):
        """A function that reads the chunk of a name."""
        folder = self.folder

        def read(name: int) -> Chunk:
            store, base = file_system(folder)
            with store.open_input_stream(f"{base}/{name}") as source:
                return Chunk.read(source)

        return read

    def map(self, body, schema: str) -> DataFrame:
        """body(name, chunk) of all chunks, some in each task; yields batches."""
        read = self.reader()

        def run(batches):
            for batch in batches:
                for name in batch.column("chunk").to_pylist():
                    yield from body(name, read(name))

        return self.names.repartitionByRange(self.tasks, "chunk").mapInArrow(run, schema)


def _segment(key: np.ndarray, segments: int) -> np.ndarray:
    return (((key >> U(32)) * U(segments)) >> U(32)).astype(np.int64)


def _places(key: np.ndarray, level: np.ndarray | int, size: np.ndarray | int):
    """The PROBES bits, in a segment of that size, of an entry."""
    x = _mix(key + U(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))
    at, step = x & U(0xFFFFFFFF), (x >> U(32)) | U(1)
    for k in range(PROBES):
        yield (at + U(k) * step) % np.asarray(size, np.uint64)


def word_counts(chunks: Chunks) -> DataFrame:
    """(word binary, n) of the training tokens. Tasks add up before the shuffle."""

    def run(_, chunk):
        n = chunk.word_counts()
        rows = pa.RecordBatch.from_arrays([chunk.words.cast(pa.binary()), pa.array(n)], ["word", "n"])
        yield rows.filter(pa.array(n > 0))

    return chunks.map(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _hashed(counts: DataFrame, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [xxhash.xxh3_64_intdigest(w, seed) for w in batch.column("word").to_pylist()]
            h = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([h, batch.column("n")], ["h", "n"])

    return counts.mapInArrow(run, "h long, n long")


def vocabulary(chunks: Chunks) -> tuple[DataFrame, int]:
    """(h, n): training tokens by a hash, under the first seed that keeps all words apart."""
    counts = stage(word_counts(chunks), "words")
    seed = 0
    while True:
        hashed = stage(_hashed(counts, seed), "hashed")
        if hashed.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").isEmpty():
            return hashed, seed
        seed += 1


def _sent(chunks: Chunks, segments: int, seed: int, order: int, held_out: bool) -> DataFrame:
    """The chunks' n-grams at the segments: a row for each chunk, length of n-gram and part,
    that is TASK_SEGMENTS segments next to each other; a partition has one part.

    keys has the differences of the sorted keys from the first on; n the training counts.
    task is the one that read the chunk.
    """

    def run(name, chunk):
        from pyspark import TaskContext

        for gram, (key, n, _) in enumerate(chunk.grams(seed, order)):
            if not held_out:
                key, n = key[n > 0], n[n > 0]
            if not len(key):
                continue
            part = _segment(key, segments) // TASK_SEGMENTS  # in order, as the hash's upper bits make the segment
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(cuts[1:], len(key))
            rest = np.diff(key, prepend=key[:1])
            rest[cuts] = 0
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(part[cuts], pa.int32()),
                "task": pa.array(np.full(len(cuts), TaskContext.get().partitionId()), pa.int32()),
                "chunk": pa.array(np.full(len(cuts), name), pa.int64()),
                "gram": pa.array(np.full(len(cuts), gram), pa.int32()),
                "size": pa.array(ends - cuts, pa.int64()),
                "first": pa.array(key[cuts].view(np.int64)),
                "keys": pa.array([_planes(rest[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary()),
                "n": pa.array([_planes(n[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            })

    rows = chunks.map(run, "part int, task int, chunk long, gram int, size long, first long, keys binary, n binary")
    return rows.repartitionById(-(-segments // TASK_SEGMENTS), "part")


def _received(batches):
    """What came for each part: a table of its rows, and the keys and counts of all of them."""
    batches = [b for b in batches if b.num_rows]
    whole = pa.Table.from_batches(batches) if batches else None
    batches.clear()
    for part in whole.column("part").unique().to_pylist() if whole else []:
        rows = whole.filter(pc.equal(whole.column("part"), part))
        key, n = [], []
        for size, first, keys, counts in zip(*(rows.column(c) for c in ("size", "first", "keys", "n")), strict=True):
            rest = _values(keys.as_buffer(), size.as_py())
            key.append(np.cumsum(rest, dtype=np.uint64) + U(first.as_py() % 2**64))
            n.append(_values(counts.as_buffer(), size.as_py()).view(np.int64))
        yield rows.drop_columns(["keys", "n"]), np.concatenate(key), np.concatenate(n)


def _by_segment(key: np.ndarray, segments: int):
    """The segments of a part, and which keys are in each."""
    of = _segment(key, segments)
    for segment in range(of.min(), of.max() + 1):
        yield segment, np.flatnonzero(of == segment)


def _added(key: np.ndarray, n: np.ndarray):
    """Distinct keys, the sums of their counts, and the place of each given key among them."""
    once, at = np.unique(key, return_inverse=True)
    sums = np.zeros(len(once), np.int64)
    np.add.at(sums, at, n)
    return once, sums, at


def _built(key: np.ndarray, n: np.ndarray, bits_each: float) -> tuple[int, bytes]:
    """A segment, that is its size and bits, of n-grams that are n times in training documents."""
    level = np.searchsorted(LEVELS, n, side="right")
    size = max(64, int(bits_each * level.sum()))
    bits = np.zeros(-(-size // 8) * 8, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        for place in _places(key[level >= q], q, size):
            bits[place.astype(np.int64)] = True
    return size, np.packbits(bits, bitorder="little").tobytes()


def bloom_filter(chunks: Chunks, segments: int, seed: int, order: int = ORDER) -> DataFrame:
    """(segment, size, bits): the written segments of the training n-grams' filter."""

    def build(batches):
        for _, key, n in _received(batches):
            for segment, here in _by_segment(key, segments):
                once, sums, _ = _added(key[here], n[here])
                size, bits = _built(once, sums, BITS)
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([segment], pa.int32()),
                    "size": pa.array([size], pa.int64()),
                    "bits": pa.array([bits], pa.binary()),
                })

    sent = _sent(chunks, segments, seed, order, held_out=False)
    return stage(sent.mapInArrow(build, "segment int, size long, bits binary"), "filter")


@dataclass
class Filter:
    """Segments that lie one after another; a missing segment holds nothing."""

    segments: int
    sizes: np.ndarray  # bits of each segment
    begins: np.ndarray  # its first byte
    bits: np.ndarray

    @classmethod
    def of(cls, rows, segments: int) -> "Filter":
        sizes, begins = np.full(segments, 1, np.int64), np.zeros(segments, np.int64)
        parts, at = [np.zeros(1, np.uint8)], 1  # where missing segments look
        for segment, size, bits in rows:
            sizes[segment], begins[segment] = size, at
            parts.append(np.frombuffer(bits, np.uint8))
            at += len(parts[-1])
        return cls(segments, sizes, begins, np.concatenate(parts))

    def levels(self, key: np.ndarray) -> np.ndarray:
        """By repeated probes: the level of each key, 0 if it is not known."""
        out = np.zeros(len(key), np.uint8)
        for a in range(0, len(key), PROBED_ROWS):
            self._probe(key[a : a + PROBED_ROWS], out[a : a + PROBED_ROWS])
        return out

    def _probe(self, key: np.ndarray, out: np.ndarray) -> None:
        of = _segment(key, self.segments)
        alive, size, begin = np.arange(len(key)), self.sizes[of], self.begins[of]
        for q in range(1, len(LEVELS)):
            there = np.ones(len(alive), bool)
            for place in _places(key[alive], q, size[alive]):
                place = place.astype(np.int64)
                there &= (self.bits[begin[alive] + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
            alive = alive[there]
            if not len(alive):
                break
            out[alive] = q


@dataclass(frozen=True)
class Totals:
    tokens: int  # N
    words: int  # V


def _scores(lengths, order: int, totals: Totals, n, counts):
    """Per document: tokens, known ones, base and model log10 probabilities.

    lengths include the beginnings; n and counts are given for each place: how often its
    word is in training documents, and what the filter counts the n-grams that end there,
    for 1 to order words.
    """
    first = np.cumsum(lengths) - lengths
    real = np.arange(len(n)) - np.repeat(first, lengths) >= order - 1  # words and ends, not beginnings
    n = np.where(real, n, 0)
    base = np.log10((n + 1) / (totals.tokens + totals.words + 1))
    p = (counts[0] + 1) / (totals.tokens + totals.words + 1)
    for k in range(1, order):
        context = np.concatenate([counts[k - 1][:1], counts[k - 1][:-1]])
        joint = np.minimum(counts[k], context)
        p = (joint + SMOOTHING * p) / (context + SMOOTHING)
    per = lambda x: np.add.reduceat(np.where(real, x, 0), first)
    return lengths - (order - 1), per(n > 0), per(base), per(np.log10(p))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(ids, totals: Totals, found) -> pa.RecordBatch:
    n_tokens, n_known, base, score = found
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()),
        "held_out": pa.array([not in_training(d) for d in ids]),
        "n_tokens": pa.array(n_tokens, pa.int64()),
        "n_known": pa.array(n_known, pa.int64()),
        "train_tokens": pa.array(np.full(len(ids), totals.tokens), pa.int64()),
        "base_score": pa.array(base, pa.float64()),
        "score": pa.array(score, pa.float64()),
    })


def _count_in(h: np.ndarray, n: np.ndarray):
    def look_up(key):
        if not len(h):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(h, key), len(h) - 1)
        return np.where(h[at] == key, n[at], 0)

    return look_up


def _chunk_scores(chunk: Chunk, totals: Totals, seed: int, order: int, n_of, levels_of) -> pa.RecordBatch:
    """n_of(keys) of single words and levels_of(length - 1, keys) give counts and levels."""
    counts = []
    for k, (key, _, at) in enumerate(chunk.grams(seed, order)):
        if not k:
            n = n_of(key)[at]
        counts.append(COUNTS[levels_of(k, key)][at])
    return _scored(chunk.ids, totals, _scores(chunk.whole_lengths(order), order, totals, n, counts))


def _broadcast_scores(chunks, vocabulary_, segments, totals, seed, order) -> DataFrame:
    context = vocabulary_.sparkSession.sparkContext
    filter_ = bloom_filter(chunks, segments, seed, order)
    known = vocabulary_.toArrow()
    key, n = _mix(known.column("h").to_numpy().view(np.uint64)), known.column("n").to_numpy()
    by_key = np.argsort(key)
    counts = context.broadcast((key[by_key], n[by_key]))
    rows = filter_.toArrow()
    columns = (rows.column("segment").to_pylist(), rows.column("size").to_pylist(), rows.column("bits"))
    parts = ((s, size, bits.as_buffer()) for s, size, bits in zip(*columns, strict=True))
    whole = context.broadcast(Filter.of(parts, segments))

    def run(_, chunk):
        levels_of = lambda _, key: whole.value.levels(key)
        yield _chunk_scores(chunk, totals, seed, order, _count_in(*counts.value), levels_of)

    return chunks.map(run, SCORES)


def _routed_scores(chunks, segments, totals, seed, order) -> DataFrame:
    """The task that builds a segment answers for it.

    An n-gram goes once from each chunk to its segment and its level, a byte, comes back: what
    moves depends on distinct n-grams, and a common one is no more than a row of each chunk.
    The exact counts of words come with the answers.
    """

    def answer(batches):
        for rows, key, n in _received(batches):
            sizes, single = rows.column("size").to_numpy(), rows.column("gram").to_numpy() == 0
            of_word = np.repeat(single, sizes)
            level, exact = np.zeros(len(key), np.uint8), np.zeros(len(key), np.int64)
            for segment, here in _by_segment(key, segments):
                once, sums, at = _added(key[here], n[here])
                filter_ = Filter.of([(segment, *_built(once, sums, BITS))], segments)
                level[here] = filter_.levels(once)[at]
                sums[:] = 0
                np.add.at(sums, at, np.where(of_word[here], n[here], 0))
                exact[here] = sums[at]
            ends = np.cumsum(sizes)
            bounds = list(zip(ends - sizes, ends, single, strict=True))
            yield pa.RecordBatch.from_pydict({
                **{c: rows.column(c).combine_chunks() for c in ("part", "task", "chunk", "gram")},
                "levels": pa.array([level[a:b].tobytes() for a, b, _ in bounds], pa.binary()),
                "n": pa.array([_planes(exact[a:b]) if word else b"" for a, b, word in bounds], pa.binary()),
            })

    sent = _sent(chunks, segments, seed, order, held_out=True)
    answers = sent.mapInArrow(answer, "part int, task int, chunk long, gram int, levels binary, n binary")
    back = answers.repartitionById(chunks.tasks, "task").sortWithinPartitions("chunk", "gram", "part")
    read = chunks.reader()

    def score(batches):
        name, levels, n = None, [], []  # of the chunk whose answers come

        def levels_of(k, key):
            found = np.frombuffer(b"".join(levels[k]), np.uint8)
            if len(found) != len(key):
                raise ValueError("not every segment has answered")
            return found

        def close():
            n_of = lambda _: np.concatenate(n).astype(np.int64)
            return _chunk_scores(read(name), totals, seed, order, n_of, levels_of)

        for batch in batches:
            for chunk, gram, found, words in zip(*(batch.column(c).to_pylist() for c in ("chunk", "gram", "levels", "n")), strict=True):
                if chunk != name:
                    if name is not None:
                        yield close()
                    name, levels, n = chunk, [[] for _ in range(order)], []
                levels[gram].append(found)
                if not gram:
                    n.append(_values(words, len(found)))
        if name is not None:
            yield close()

    return back.select("chunk", "gram", "levels", "n").mapInArrow(score, SCORES)


def score(docs: DataFrame, order: int = ORDER, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """SCORES for every row of docs(doc_id, text), learnt from the rows in_training().

    Every text is scored whole, its end included; a null text is empty, that is the end
    alone. A row without doc_id is held out. Repeated rows count, and return, repeated.
    Without training rows nothing is known and every token is as likely as any. An empty
    table gives an empty result. Other columns are ignored, whatever their names.

    The filter and the word counts are broadcast if they take broadcast_bytes at most,
    which the tokens bound before any n-gram is counted.
    """
    chunks = Chunks.of(docs)
    vocabulary_, seed = vocabulary(chunks)
    n, v = vocabulary_.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    totals, segments = Totals(n, v), max(1, -(-n // SEGMENT_TOKENS))
    most = BITS / 8 * order * n + 16 * v  # an n-gram's level is its count at most
    if most <= broadcast_bytes:
        return _broadcast_scores(chunks, vocabulary_, segments, totals, seed, order)
    return _routed_scores(chunks, segments, totals, seed, order)


def op13_lm_scoring(spark, sf_dir):
    """score() of all documents; nulls, odd texts, repeated rows and empty tables as there."""
    return score(table(spark, sf_dir, "documents"))
