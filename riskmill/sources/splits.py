"""Frozen splits: saved row ids with the conditions they were made under."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.functions.durable import take_bounded
from riskmill.operators.split import stratified_split
from riskmill.sources.reports import read_metadata, write_metadata
from riskmill.spec import SEED, TEST_SIZE


@dataclass
class SavedSplit:
    ids: DataFrame  # row id and part
    reused: bool
    info: dict


def load_or_create_split(
    df: DataFrame,
    folder: str,
    label: str,
    row_id: str,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    method: str = "xxhash64",
    overwrite: bool = False,
) -> SavedSplit:
    """Reuse a saved split if it was made for this table in this way, else make one.

    A saved split fits when row count, seed, stratify column, test share, hash method and
    row id match.
    The ids are a Parquet table; the record that names it is written last, so a
    split that was interrupted is never picked up.
    """
    spark = df.sparkSession
    wanted = {
        "n_rows": df.count(),
        "test_size": test_size,
        "random_state": seed,
        "stratify_column": label,
        "method": method,
        "row_id": row_id,
    }
    saved = {} if overwrite else read_metadata(spark, f"{folder}/split.json")
    if saved and all(saved.get(key) == value for key, value in wanted.items()):
        return SavedSplit(spark.read.parquet(saved["ids"]), True, {**saved, "reused": True})

    path = f"{folder}/ids-{uuid.uuid4().hex}"
    parts = stratified_split(df, label, row_id, test_size, seed, method)
    parts.where(F.col("part").isNotNull()).select(row_id, "part").write.parquet(path)
    ids = spark.read.parquet(path)
    sizes = {row["part"]: row["count"] for row in take_bounded(ids.groupBy("part").count(), 2, "parts")}
    info = {
        **wanted,
        "n_train": sizes.get("train", 0),
        "n_test": sizes.get("test", 0),
        "ids": path,
        "reused": False,
    }
    write_metadata(spark, info, f"{folder}/split.json")
    return SavedSplit(ids, False, info)


def read_split_positions(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """Read a split saved as JSON position lists: ids ``row_id, part`` and its record."""
    document = spark.read.option("multiLine", True).schema(
        "n_rows bigint, test_size double, random_state int, stratify_column string, "
        "n_train bigint, n_test bigint, train_index array<bigint>, test_index array<bigint>"
    ).json(path)
    ids = document.select(F.explode("train_index").alias("row_id"), F.lit("train").alias("part"))
    ids = ids.unionByName(
        document.select(F.explode("test_index").alias("row_id"), F.lit("test").alias("part"))
    )
    info = document.drop("train_index", "test_index").first().asDict()
    return ids, info
