"""Reading and writing tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from riskmill.functions.durable import take_bounded
from riskmill.sources.fingerprint import verify_files
from riskmill.spec import TableSpec

# Result tables: one row per scenario, target, stage, model and metric.
RESULT_SCHEMA = (
    "scenario string, scenario_label string, target string, stage string, model string, "
    "metric string, train_mean double, cv_mean double, cv_std double, gap double, "
    "n_features int, best_params string"
)


class DataNotFoundError(FileNotFoundError):
    """The path of a table does not exist."""


#: Files of one table that an error can name.
MAX_FILES = 1_000_000


class IntegrityError(ValueError):
    """Files differ from their recorded fingerprints; ``files`` holds all of them."""

    def __init__(self, files: list[dict]):
        super().__init__("changed files: " + ", ".join(f["path"] for f in files))
        self.files = files


def spec_schema(spec: TableSpec) -> T.StructType:
    """Read schema of a raw table, so that no file is scanned to infer types."""
    return T.StructType.fromDDL(", ".join(f"`{c}` {spec.type_of(c)}" for c in spec.columns))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Read a Parquet or CSV table; a missing path is a clear error.

    CSV needs a schema: inferring it would read all files twice. The header row
    is used to match columns by position, as Spark does.
    """
    try:
        if _is_csv(path):
            if schema is None:
                raise ValueError(f"a CSV table needs a schema: {path}")
            return spark.read.options(header=True, **options).schema(schema).csv(path)
        reader = spark.read.options(**options)
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DataNotFoundError(f"no table at {path}") from error
        raise


def _is_csv(path: str) -> bool:
    return path.rstrip("/").endswith((".csv", ".csv.gz"))


def read_raw_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Read a raw table as it is, after an optional fingerprint check.

    ``expected`` has the columns ``path`` and ``expected_sha256``; any file that
    differs stops the read.
    """
    if expected is not None:
        checked = verify_files(spark, path, expected).where("not ok")
        bad = take_bounded(checked.orderBy("path"), MAX_FILES, "changed files")
        if bad:
            raise IntegrityError([row.asDict() for row in bad])
    return read_table(spark, path, spec_schema(spec) if _is_csv(path) else None)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write a table as Parquet or, for a ``.csv`` path, as CSV with a header.

    The folder is created where needed, and holds one file per task.
    """
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if _is_csv(path):
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def save_results(results: DataFrame, path: str) -> str:
    """Save a result table; these are a few hundred rows, so one file is enough."""
    return write_table(results.coalesce(1), path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RESULT_SCHEMA)
