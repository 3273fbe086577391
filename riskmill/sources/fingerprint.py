"""SHA-256 fingerprints of data files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

#: The binary reader keeps a file's content in one row, which ends at 2 GiB.
IN_ROW_LIMIT = 2**31 - 2**20
#: Schemes of Spark's file systems whose names differ in the library that streams larger files.
STREAM_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfss", "gs": "gs", "hdfs": "hdfs", "file": "file", "s3": "s3"}
_CHUNK = 4 * 1024 * 1024


def file_fingerprints(
    spark: SparkSession, path: str, in_row_limit: int = IN_ROW_LIMIT, tasks: int | None = None
) -> DataFrame:
    """Path, length and SHA-256 of every file below ``path``.

    Spark reads and hashes all files that fit in one of its rows. Only files of 2 GiB or
    more are streamed through the hash in chunks, one task per file; a scheme that cannot
    be streamed is an error that names it. Empty files are in Spark's listing but never
    in its scans, so they are added.
    """
    listing = _listing(spark, path)
    small = listing.where(F.col("length") <= in_row_limit).select(
        "path", "length", F.sha2("content", 256).alias("actual_sha256")
    )
    large = listing.where(F.col("length") > in_row_limit).select("path", "length")
    spread = large.repartition(tasks or spark.sparkContext.defaultParallelism, "path")
    hashed = spread.mapInPandas(_stream_hashes, "path string, length bigint, actual_sha256 string")

    listed = spark.createDataFrame([(p,) for p in listing.inputFiles()], "uri string")
    named = listed.select(F.regexp_replace("uri", "^file:/+", "file:/").alias("path"))
    return named.join(small.unionByName(hashed), "path", "left").select(
        "path",
        F.coalesce("length", F.lit(0)).alias("length"),
        F.coalesce("actual_sha256", F.lit(hashlib.sha256().hexdigest())).alias("actual_sha256"),
    )


def _listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def _stream_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        digests = []
        for uri in batch["path"]:
            scheme, _, rest = uri.partition(":")
            if scheme not in STREAM_SCHEMES:
                raise ValueError(f"files of 2 GiB or more cannot be streamed from {scheme}: {uri}")
            system, name = fs.FileSystem.from_uri(f"{STREAM_SCHEMES[scheme]}:{rest}")
            digest = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(_CHUNK):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(actual_sha256=digests)


def verify_files(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Compare fingerprints with recorded ones by path.

    Files without a record and records without a file are not ok.
    """
    return file_fingerprints(spark, path).join(expected, "path", "full_outer").select(
        "path",
        "expected_sha256",
        "actual_sha256",
        F.coalesce(F.col("actual_sha256") == F.col("expected_sha256"), F.lit(False)).alias("ok"),
    )
