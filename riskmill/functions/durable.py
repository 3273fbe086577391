"""Size-checked driver hand-over and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by the session.

    A local session without the setting gets its own temporary folder. On a
    cluster the setting is required, because a machine-local folder is gone with
    its machine.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache
def _local_folder(application: str) -> str:
    """One temporary folder per local application."""
    return tempfile.mkdtemp(prefix=f"riskmill-{application}-")


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    Used where one table feeds several jobs. Unlike a cache the result survives
    lost executors, and unlike an RDD checkpoint it keeps column pruning, filter
    pushdown and file sizes for the optimizer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def take_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Rows of a result that must be small; more than ``max_rows`` is an error.

    For results whose size follows from parameters (metrics per fold, columns
    profiled, classes of a label), never for data rows.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows")
    return rows


def small_table(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    """``df`` computed once, as a table of checked size that joins by broadcast."""
    rows = take_bounded(df, max_rows, what)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
