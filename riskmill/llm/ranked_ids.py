"""Token ids as files: frequency ranks in byte-aligned variable-length coding.

An id is replaced by its rank in the corpus (0 is the most frequent), and a rank takes one
to four little-endian bytes without leading zeros. Lengths stand apart: two bits
per rank, four ranks in a control byte, all control bytes of a block before its data
bytes, so that a decoder knows from a control byte and a table of 256 rows where its
four ranks lie.

A file holds blocks, each followed by one byte 0x0A. A block is (little-endian):

    magic 4 bytes, part uint32, number uint32, documents uint32, null names uint32, ids uint64, data bytes uint64
    doc_ids int64 x documents, lengths uint32 x documents
    control bytes ((ids + 3) // 4), data bytes

``part`` and ``number`` give the order of blocks; the first ``null names`` documents of a block have no doc_id.
A file ends after ``FILE_BYTES`` or one longer block. A second folder, ``ranks``, holds the
table rank -> id, which is as long as the vocabulary.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskmill.functions.durable import take_bounded
from riskmill.llm.chunks import slices, word_encoder
from riskmill.llm.common import FILE_BYTES, in_files, materialize, new_folder, plain, read_blobs, running_start, write_blobs

MAGIC = b"FRV2"
HEAD = struct.Struct("<4sIIIIQQ")
#: Ids in a block; a longer document has a block of its own.
BLOCK_IDS = 1 << 18
MAX_VOCABULARY = 1 << 20

LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.int64)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of an array of ranks below 2 ** 32."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.int64) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    raw = ranks.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ranks back: lengths by table lookup, then one gather per byte position."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    starts = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = np.zeros(count, np.uint32)
    for i in range(4):
        ranks |= np.where(size > i, raw[starts + i].astype(np.uint32) << np.uint32(8 * i), np.uint32(0))
    return ranks


def _encode(path: str, end_id: int):
    """Rows (doc_id, ids) from (doc_id, text), every document closed by ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            for part in slices(batch, 1):
                at = 0
                for ids in encoder.encode_arrays(part.column(1), end_id):
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(at, len(ids)), ids], ["doc_id", "ids"])
                    at += len(ids)

    return run


def pack_block(part: int, number: int, names: list[int | None], ids: list[bytes], rank_of: np.ndarray) -> bytes:
    nulls = sum(name is None for name in names)
    flat = np.frombuffer(b"".join(ids), "<u2")
    control, data = pack(rank_of[flat])
    head = HEAD.pack(MAGIC, part, number, len(names), nulls, len(flat), len(data))
    lengths = np.array([len(x) // 2 for x in ids], "<u4")
    return head + np.array([0] * nulls + names[nulls:], "<i8").tobytes() + lengths.tobytes() + control + data


def _pack_blocks(rank_of: np.ndarray, block_ids: int):
    """One block after the other from documents in their final order."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        part, number, names, held, total = TaskContext.get().partitionId(), 0, [], [], 0
        rows = (row for batch in batches for cut in slices(batch, 1) for row in zip(*(c.to_pylist() for c in cut.columns)))
        for doc, ids in rows:
            if names and total + len(ids) // 2 > block_ids:
                yield pack_block(part, number, names, held, rank_of)
                number, names, held, total = number + 1, [], [], 0
            names.append(doc)
            held.append(ids)
            total += len(ids) // 2
        if names:
            yield pack_block(part, number, names, held, rank_of)

    return lambda batches: in_files(blocks(batches), b"\n", "block", FILE_BYTES)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for part in slices(batch, 0):
            counts += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), "<u2"), minlength=len(counts))
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], ["id", "n"])


def rank_table(encoded: DataFrame) -> np.ndarray:
    """ids by falling corpus frequency, ties by id. As long as the vocabulary at most."""
    counts = encoded.select("ids").mapInArrow(_counts, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = take_bounded(counts, MAX_VOCABULARY, "token ids")
    return np.array([i for _, i in sorted((-r.n, r.id) for r in rows)], "<u4")


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = 1, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer at ``path`` into ``folder``.

    Documents lie in ascending doc_id order over all files (equal doc_ids by their ids, a
    null text is empty, null doc_ids come first), each followed by ``end_id``. The tokenizer
    runs once, its ids are kept in the shared folder until their ranks are known, and
    are range partitioned once. No task holds more than a block and a batch.
    """
    texts = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = materialize(texts.mapInArrow(_encode(path, end_id), "doc_id bigint, ids binary"), "ids")
    order = rank_table(encoded)
    rank_of = np.zeros(1 << 16, "<u4")
    rank_of[order] = np.arange(len(order))
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    packed = ordered.mapInArrow(_pack_blocks(rank_of, block_ids), "block binary")
    write_blobs(packed, "block", b"\n", f"{folder}/blocks")
    spark = docs.sparkSession
    ranks = spark.createDataFrame([(bytearray(order.tobytes()),)], "ids binary").coalesce(1)
    write_blobs(ranks, "ids", b"\n", f"{folder}/ranks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(part, number, place, doc_id, n_tokens, ids) from the files; ids little-endian uint32."""
    ids_of = _read_ranks(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from _documents(memoryview(content.as_buffer()), ids_of)

    ddl = "part int, number int, place int, doc_id bigint, n_tokens bigint, ids binary"
    return read_blobs(spark, f"{folder}/blocks").select("content").mapInArrow(run, ddl)


def _read_ranks(spark: SparkSession, folder: str) -> np.ndarray:
    rows = take_bounded(read_blobs(spark, f"{folder}/ranks"), 1, "rank tables")
    return np.frombuffer(bytes(rows[0].content[:-1]), "<u4") if rows else np.zeros(0, "<u4")


def _blocks(view: memoryview):
    """(part, number, nulls, doc_ids, lengths, control, data) of every block of a file."""
    at = 0
    while at < len(view):
        magic, part, number, docs, nulls, count, size = HEAD.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError("not a block of ids")
        at += HEAD.size
        doc_ids = np.frombuffer(view[at : at + 8 * docs], "<i8")
        lengths = np.frombuffer(view[at + 8 * docs : at + 12 * docs], "<u4")
        at += 12 * docs
        control = view[at : at + (count + 3) // 4]
        at += len(control)
        yield part, number, nulls, doc_ids, lengths, bytes(control), bytes(view[at : at + size])
        at += size + 1


def _documents(view: memoryview, ids_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    for part, number, nulls, doc_ids, lengths, control, data in _blocks(view):
        ids = ids_of[unpack(control, data, int(lengths.sum()))].astype("<u4")
        offsets = np.concatenate(([0], 4 * np.cumsum(lengths, dtype=np.int64)))
        many = len(doc_ids)
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), many, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(many, part, np.int32)), pa.array(np.full(many, number, np.int32)),
             pa.array(np.arange(many, dtype=np.int32)), pa.array(doc_ids, mask=np.arange(many) < nulls), pa.array(lengths.astype(np.int64)), cut],
            ["part", "number", "place", "doc_id", "n_tokens", "ids"],
        )


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([zlib.crc32(x.as_buffer()) for x in batch.column(5)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], marks], [*batch.schema.names[:5], "ids_crc32"])

    ddl = "part int, number int, place int, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    found = materialize(read_ids(spark, folder).mapInArrow(run, ddl), "stored")
    key = ["part", "number"]
    totals = running_start(found.groupBy(*key).agg(F.sum("n_tokens").alias("n")), key, "n", "before").drop("n")
    within = F.sum("n_tokens").over(_inside())
    placed = found.withColumn("inside", F.coalesce(within, F.lit(0)))
    return placed.join(totals, key).select(
        "doc_id", (F.col("before") + F.col("inside")).cast("long").alias("start"), "n_tokens", "ids_crc32"
    )


def _inside():
    return Window.partitionBy("part", "number").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` and read the files back, see ``stored_documents``."""
    spark = docs.sparkSession
    folder = new_folder(spark, "ranked-ids")
    write_ids(docs, folder, path, end_id)
    return stored_documents(spark, folder)
