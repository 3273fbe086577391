"""Nested reports and model metadata as JSON."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskmill.functions.durable import take_bounded
from riskmill.functions.parallel import run_together

# Report sections are tables of columns, classes or files, never data rows.
MAX_SECTION_ROWS = 10_000


def write_report(
    sections: Mapping[str, DataFrame],
    facts: Mapping[str, Column],
    path: str,
    parallelism: int = 4,
    ready: DataFrame | None = None,
) -> DataFrame:
    """Write a report of several small tables as one nested JSON record.

    Each section becomes an array of structs. Its size is checked, because a
    section is one value of one row. The sections are independent jobs; ``ready`` is
    one row of sections that are arrays already.
    """
    if not sections and ready is None:
        raise ValueError("a report needs at least one section")
    spark = ready.sparkSession if ready is not None else next(iter(sections.values())).sparkSession
    tasks = [
        lambda name=name, section=section: take_bounded(
            section, MAX_SECTION_ROWS, f"report section {name}"
        )
        for name, section in sections.items()
    ]
    values = run_together(tasks, parallelism, spark)
    schema = T.StructType(
        [T.StructField(name, T.ArrayType(section.schema)) for name, section in sections.items()]
    )
    if ready is not None:
        row = ready.first()
        for name, value in row.asDict().items():
            if value is not None and len(value) > MAX_SECTION_ROWS:
                raise ValueError(f"report section {name}: more than {MAX_SECTION_ROWS} rows")
        values, schema = [*row, *values], T.StructType([*ready.schema.fields, *schema.fields])
    report = spark.createDataFrame([tuple(values)], schema).withColumns(
        {"generated_at": F.current_timestamp(), **facts}
    )
    report.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(report.schema).json(path)


def write_metadata(spark: SparkSession, metadata: Mapping, path: str) -> None:
    """Write model metadata as one JSON document."""
    document = json.dumps(metadata, ensure_ascii=False)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    """Read model metadata; a missing file gives an empty dictionary."""
    try:
        rows = spark.read.option("wholetext", True).text(path).take(1)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return json.loads(rows[0]["value"]) if rows else {}
