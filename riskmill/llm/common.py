"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskmill.functions.durable import checkpoint_dir, materialize

#: A documented bound for tables with one row per partition, file or vocabulary entry.
MAX_SMALL_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash."""
    return docs.select(*(F.col(f"`{c}`").alias(c) for c in columns))


def unused(df: DataFrame, many: int, mark: str = "slot") -> list[str]:
    """So many column names that ``df`` does not have."""
    while any(c.lower().startswith(mark) for c in df.columns):
        mark += "_"
    return [f"{mark}{i}" for i in range(many)]


def with_row_key(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once with a unique number for every row, and the unused column name of that number."""
    key = unused(df, 1, "row_key")[0]
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), name), key


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Bytes of a file of ``in_files``, unless one item alone is longer.
FILE_BYTES = 16_000_000


def in_files(items: Iterable[bytes], end: bytes, column: str, most: int = FILE_BYTES) -> Iterator[pa.RecordBatch]:
    """One row per file of ``write_blobs``: items in order, ``end`` between them, up to ``most`` bytes or one item."""
    held, size = [], 0
    row = lambda: pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], [column])
    for item in items:
        if held and size + len(item) > most:
            yield row()
            held, size = [], 0
        held.append(item)
        size += len(item) + len(end)
    if held:
        yield row()


def write_blobs(df: DataFrame, column: str, end: bytes, folder: str, per_file: int = 1, compression: str = "none") -> None:
    """Write one binary column as raw files: the bytes of each row, then ``end``, ``per_file`` rows in a file.

    Spark's text writer copies a string's bytes unchanged, so it also writes binary
    data, through the commit protocol of Spark and on any file system it knows.
    Rows keep their order in the file names; ``compression`` is one of Spark's codecs.
    """
    writer = df.select(F.col(column).cast("string").alias("value")).write.option("maxRecordsPerFile", per_file)
    writer = writer.option("compression", compression).option("lineSep", end.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.text(folder)


def read_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """Files of ``write_blobs`` as rows (path, content), empty files left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.filter("length > 0").select(F.regexp_extract("path", "([^/]+)$", 1).alias("path"), "content")


def running_start(sums: DataFrame, order: list[str], value: str, name: str = "start") -> DataFrame:
    """Exclusive running total over a table with one row per file or partition.

    One task handles it: the table has one short row per file, never one per document.
    """
    rows = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(name, F.coalesce(F.sum(value).over(rows), F.lit(0)).cast("long"))


#: Groups that hold over one row in so many are joined by broadcast, so there are fewer of them than this.
HOT = 4096


def join_sized(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Left join of the written table ``rows`` with ``groups``, one row per key whose ``size`` counts its rows.

    The few largest groups are broadcast, fewer than ``HOT`` by their size, so no key of the shuffled join
    holds more than one row in ``HOT`` of the table.
    """
    hot = F.col(size) > max(1, rows.count() // HOT)
    large = rows.join(F.broadcast(groups.filter(hot)), keys, "left")
    small = large.filter(F.col(size).isNull()).select(*rows.columns).join(groups.filter(~hot), keys, "left")
    return large.filter(F.col(size).isNotNull()).unionByName(small)


__all__ = ["MAX_SMALL_ROWS", "in_files", "join_sized", "let", "materialize", "new_folder", "plain", "read_blobs", "running_start", "table",
           "text_or_empty", "unused", "with_row_key", "write_blobs"]
