"""Token files: ids of documents in patched frame-of-reference blocks.

A file holds whole documents. Its ids are cut into blocks of BLOCK; a block keeps its
minimum, the differences to it in a width that fits all but a share of them (the
percentile of fewest bytes), and the rest as exceptions (position, difference). An index
says where each block starts, so a reader can unpack any one alone.

File, little-endian: magic, u4 x 4 (documents, blocks, ids in a block, ids in the last
block), i8 doc_id each, u1 doc_id present each, i8 number of ids each, u8 block starts
(one more than blocks), then the blocks: u4 minimum, u1 width, u1 pad, u2 exceptions,
packed bits, u2 positions, u4 differences.
"""

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.tokens import END_ID, Encoder, tokenizer_path
from cartloom.plans.staging import staged_folder

MAGIC = b"PFORIDS1"
BLOCK = 1024
PERCENTILES = (90, 98, 100)
FILE_IDS = 1 << 18  # a file is closed once it holds so many ids
EXCEPTION_BITS = 48


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _largest(width) -> np.ndarray:
    """The largest value of a width."""
    return ((np.uint64(1) << np.asarray(width, np.uint64)) - np.uint64(1)).astype(np.uint32)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of uint32 as rows of bytes, width bits a value."""
    kind = "<u2" if width <= 16 else "<u4"
    raw = values.astype(kind).view(np.uint8).reshape(*values.shape, -1)
    bits = np.unpackbits(raw, axis=-1, bitorder="little")
    return np.packbits(bits[..., :width].reshape(len(values), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, bitorder="little", count=BLOCK * width)
    kind, full = ("<u2", 16) if width <= 16 else ("<u4", 32)
    wide = np.zeros((len(packed), BLOCK, full), np.uint8)
    wide[..., :width] = bits.reshape(len(packed), BLOCK, width)
    return np.packbits(wide, axis=-1, bitorder="little").view(kind).reshape(len(packed), BLOCK)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """One byte string per block of up to BLOCK ids."""
    n = -(-len(ids) // BLOCK)
    rows = np.zeros(n * BLOCK, np.uint32)
    rows[: len(ids)] = ids
    if n:
        rows[len(ids) :] = ids[(n - 1) * BLOCK :].min()
    rows = rows.reshape(n, BLOCK)
    low = rows.min(axis=1, keepdims=True) if n else rows[:, :1]
    rest = rows - low
    ordered = np.sort(rest, axis=1)
    best = np.full(n, np.iinfo(np.int64).max)
    width = np.zeros(n, np.int64)
    for percent in PERCENTILES:
        w = _bit_length(ordered[:, -(-BLOCK * percent // 100) - 1])
        beyond = (rest > _largest(w)[:, None]).sum(axis=1)
        cost = BLOCK * w + EXCEPTION_BITS * beyond
        width, best = np.where(cost < best, w, width), np.minimum(cost, best)
    out: list[bytes] = [b""] * n
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        part = rest[at]
        packed = _pack(part & _largest(w), int(w))
        beyond = part > _largest(w)
        for k, i in enumerate(at):
            where = np.flatnonzero(beyond[k])
            count = np.array([len(where)], "<u2").tobytes()
            head = np.array([low[i, 0]], "<u4").tobytes() + bytes([int(w), 0]) + count
            tail = where.astype("<u2").tobytes() + part[k, where].astype("<u4").tobytes()
            out[i] = head + packed[k].tobytes() + tail
    return out


def decode_blocks(data: bytes, starts: np.ndarray, last: int) -> np.ndarray:
    """Ids of the consecutive blocks at `starts`; the last block holds `last` ids."""
    n = len(starts)
    raw = np.frombuffer(data, np.uint8)
    heads = raw[starts[:, None] + np.arange(8)] if n else np.zeros((0, 8), np.uint8)
    low = np.ascontiguousarray(heads[:, :4]).view("<u4").reshape(-1, 1)
    width, beyond = heads[:, 4], np.ascontiguousarray(heads[:, 6:]).view("<u2").reshape(-1)
    out = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        size = BLOCK * int(w) // 8
        out[at] = _unpack(raw[starts[at][:, None] + 8 + np.arange(size)], int(w))
    for i in np.flatnonzero(beyond):
        k, begin = int(beyond[i]), int(starts[i]) + 8 + BLOCK * int(width[i]) // 8
        where = np.frombuffer(data, "<u2", k, begin)
        out[i, where] = np.frombuffer(data, "<u4", k, begin + 2 * k)
    out += low
    return out.reshape(-1)[: max(0, (n - 1) * BLOCK + last)]


def encode_file(doc_ids: list, ids: list[bytes]) -> bytes:
    flat = np.frombuffer(b"".join(ids), "<u4")
    blocks = encode_blocks(flat)
    last = len(flat) - BLOCK * max(0, len(blocks) - 1)
    head = [
        MAGIC,
        np.array([len(doc_ids), len(blocks), BLOCK, last], "<u4"),
        np.array([d or 0 for d in doc_ids], "<i8"),
        np.array([d is not None for d in doc_ids], np.uint8),
        np.array([len(x) // 4 for x in ids], "<i8"),
    ]
    head = b"".join(x if isinstance(x, bytes) else x.tobytes() for x in head)
    first = len(head) + 8 * (len(blocks) + 1)
    starts = first + np.cumsum([0] + [len(b) for b in blocks])
    return head + starts.astype("<u8").tobytes() + b"".join(blocks)


def decode_file(data: bytes):
    """(doc_id or None, first id's place in the file, ids as bytes) of each document."""
    assert data[:8] == MAGIC, "no token file"
    docs, blocks, block, last = (int(x) for x in np.frombuffer(data, "<u4", 4, 8))
    assert block == BLOCK
    doc_ids = np.frombuffer(data, "<i8", docs, 24).tolist()
    present = np.frombuffer(data, np.uint8, docs, 24 + 8 * docs).tolist()
    lengths = np.frombuffer(data, "<i8", docs, 24 + 9 * docs).tolist()
    starts = np.frombuffer(data, "<u8", blocks + 1, 24 + 17 * docs).astype(np.int64)
    ids = decode_blocks(data, starts[:-1], last).astype("<u4").tobytes()
    at = 0
    for doc_id, known, n in zip(doc_ids, present, lengths, strict=True):
        yield (doc_id if known else None), at, ids[4 * at : 4 * (at + n)]
        at += n


def file_system(folder: str):
    """Arrow's file system for a folder that every executor reaches, and the path in it."""
    from pyarrow import fs

    if re.match("file:/", folder):
        folder = re.sub("^file:/+", "/", folder)
    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID
) -> DataFrame:
    """Write the documents' ids in ascending doc_id order; returns the index of the files.

    Rows are range-partitioned and sorted by doc_id, then encoded, so text is shuffled
    once. A null text is empty and yields the end id alone; null doc_ids come first;
    rows of equal doc_id are ordered by a hash of their text. A task writes each file
    under a temporary name and renames it; a rerun task writes the same files again.

    The index, also kept in folder/index, has file, n_ids and begin, the number of ids in
    all files before.
    """
    spark = docs.sparkSession
    tie = F.xxhash64("text").alias("tie")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), tie)
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches):
        from pyspark import TaskContext

        encoder, (store, base) = Encoder(tokenizer), file_system(folder)
        end = np.array([end_id], "<u4").tobytes()
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, ids, held = [], [], 0
        store.create_dir(base, recursive=True)

        def close():
            name = f"{part:06d}-{number:06d}.ids"
            draft = f"{base}/_{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(encode_file(doc_ids, ids))
            store.move(draft, f"{base}/{name}")
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([held], pa.int64())],
                ["file", "part", "n_ids"],
            )

        for batch in batches:
            found = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(found, batch.column("text"), strict=True):
                doc_ids.append(doc_id)
                ids.append(encoder.ids(text.as_py()) + end)
                held += len(ids[-1]) // 4
                if held >= FILE_IDS:
                    yield close()
                    doc_ids, ids, held, number = [], [], 0, number + 1
        if doc_ids:
            yield close()

    index = f"{folder}/index"
    rows.mapInArrow(run, "file string, part int, n_ids long").write.parquet(index)
    files = spark.read.schema("file string, part int, n_ids long").parquet(index)
    # Two levels: files within a task's part, then one number per part.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_begin"))
    within = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    placed = files.select("file", "part", "n_ids", earlier.alias("earlier"))
    return placed.join(begins, "part").select(
        "file", "n_ids", (F.col("part_begin") + F.col("earlier")).alias("begin")
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, doc_id, at, ids): every document of the files, ids as little-endian bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)

    def run(batches):
        for batch in batches:
            names = batch.column("file").to_pylist()
            for name, data in zip(names, batch.column("content"), strict=True):
                rows = list(decode_file(data.as_py()))
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [name] * len(rows),
                        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                        "at": pa.array([r[1] for r in rows], pa.int64()),
                        "ids": pa.array([r[2] for r in rows], pa.binary()),
                    }
                )

    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.mapInArrow(run, "file string, doc_id long, at long, ids binary")


def op7_token_id_files(spark, sf_dir):
    folder = f"{staged_folder(spark)}/tokens-{uuid.uuid4().hex}"
    index = write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    rows = read_token_files(spark, folder).select(
        "file",
        "doc_id",
        "at",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return rows.join(index, "file").select(
        "doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
