"""Token counts of documents in flat token files, found by scanning for separators.

A flat file is nothing but little-endian uint16 ids, every document closed by the
tokenizer's end-of-document id: no index, no header. Counting needs no text and no index:
blocks of a file are searched for the identifier with numpy, and a document that crosses
blocks gets its length from a prefix scan over block summaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskmill.llm.chunks import slices, word_encoder
from riskmill.llm.common import FILE_BYTES, in_files, materialize, new_folder, plain, read_blobs, write_blobs

END_ID = 49407
#: Ids searched at once.
BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Texts of ``docs`` (doc_id, text) as flat files, in the order of its partitions.

    Null texts are empty. Special strings in a text are ordinary text, so ``end_id`` never occurs inside a
    document. File names tell the partition and count up within it.
    """

    end = end_id.to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path, True)
        parts = (part.column(1) for batch in batches for part in slices(batch, 1))
        yield from in_files((ids for part in parts for found in encoder.encode_arrays(part) for ids in found.to_pylist()), end, "ids", FILE_BYTES)

    write_blobs(plain(docs, "doc_id", "text").mapInArrow(run, "ids binary"), "ids", end, folder)


def places(docs: DataFrame) -> DataFrame:
    """(doc_id, part, place): where ``write_flat`` puts every row. It reads ``docs`` just as the writer does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            many = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(many, part, np.int32)), pa.array(np.arange(at, at + many))],
                ["doc_id", "part", "place"],
            )
            at += many

    kind = dict(docs.dtypes)["doc_id"]
    return plain(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, part int, place bigint")


def scan_counts(spark: SparkSession, folder: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(path, place, start, n_tokens): one row per separator of the flat files.

    ``place`` counts documents within their file from 0, ``start`` ids before the
    document within its file, ``n_tokens`` its ids without the separator. Ids after the
    last separator are an unfinished document and are reported with a null ``place``.
    """
    step = 2 * block_ids
    blocks = read_blobs(spark, folder).select(
        "path", "content", F.posexplode(F.sequence(F.lit(0), F.length("content") - 1, F.lit(step))).alias("block", "at")
    ).select("path", "block", (F.col("at") / 2).cast("long").alias("first"),
             F.substring(F.col("content"), F.col("at") + 1, F.lit(step)).alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, first, raw in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, "<u2")
                ends = np.flatnonzero(ids == end_id) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int32()), pa.array([first + len(ids)], pa.int64()),
                     pa.array([ends], pa.list_(pa.int64()))],
                    ["path", "block", "size", "ends"],
                )

    found = materialize(blocks.mapInArrow(run, "path string, block int, size bigint, ends array<bigint>"), "scan")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = found.select("path", "block", "size", F.size("ends").alias("n"), F.array_max("ends").alias("last")).select(
        "path", "block", "size", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open"), "last",
        F.row_number().over(Window.partitionBy("path").orderBy(F.desc("block"))).alias("back"),
    )
    whole = found.select("path", "block", "ends").join(carry, ["path", "block"])
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: e + 1))
    ended = whole.select("path", "docs", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias(
        "i", "d"), "size", "back").select(
        "path", F.when(F.col("d.end").isNotNull(), F.col("docs") + F.col("i")).cast("long").alias("place"),
        F.col("d.start").alias("start"), (F.coalesce("d.end", "size") - F.col("d.start")).alias("n_tokens"), "back")
    return ended.filter("place is not null or (back = 1 and n_tokens > 0)").drop("back")


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, part, start, n_tokens) for every row of ``docs``, from flat files written for it.

    ``start`` counts the ids and separators before the document in its partition's files. Files
    know no doc_id: the k-th separator of a partition belongs to its k-th row. ``docs`` must
    read the same way twice, as stored tables do; if a partition's rows and separators differ in
    number, the query fails.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "flat-ids")
    write_flat(docs, folder, path)
    found = materialize(scan_counts(spark, folder), "counts")
    sizes = found.groupBy("path").agg(F.count("place").alias("n"), F.sum(F.col("n_tokens") + 1).alias("ids"))
    sizes = sizes.withColumn("part", F.regexp_extract("path", r"^part-(\d+)", 1).cast("int"))
    before = Window.partitionBy("part").orderBy(F.length("path"), "path").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("path", "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "ids")))
    placed = found.join(starts, "path").select(
        "part", (F.col("n_before") + F.col("place")).alias("place"), (F.col("ids_before") + F.col("start")).alias("start"), "n_tokens")
    both = materialize(places(docs), "places").join(placed, ["part", "place"], "full")
    whole = F.col("doc_id").isNotNull() | F.col("n_tokens").isNotNull()
    known = F.when(F.col("n_tokens").isNull(), F.raise_error(F.lit("flat files and documents differ")).cast("long"))
    return both.filter(whole).select("doc_id", "part", "start", F.coalesce(F.col("n_tokens"), known).alias("n_tokens"))
