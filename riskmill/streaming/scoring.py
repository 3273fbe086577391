"""A fitted pipeline applied to a stream.

Scoring reads one row at a time and keeps no state, so no watermark, window or
state store is involved: the batch operator runs on the streaming table as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, types as T

from riskmill.operators.scoring import score_table


def score_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    model: PipelineModel,
    metadata: Mapping,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Scores of the rows in every Parquet file that arrives in a folder."""
    rows = spark.readStream.schema(schema).parquet(path)
    return score_table(model, rows, metadata, keep)
