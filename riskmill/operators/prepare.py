"""The preparation job: contract, repair, duplicates, labels and quality report."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from riskmill.functions.durable import take_bounded
from riskmill.functions.numeric import column_as_double, repair_scale
from riskmill.operators import cleaning, contract, dedup, profile
from riskmill.operators.order_stats import quantiles_and_aggregates
from riskmill.sources.reports import write_report
from riskmill.spec import SEED, TableSpec


@dataclass
class Prepared:
    table: DataFrame
    report: DataFrame
    table_path: str
    report_path: str


def prepare_table(
    raw: DataFrame,
    spec: TableSpec,
    folder: str,
    order_by: Sequence[str],
    subset: Sequence[str] | None = None,
    fingerprints: DataFrame | None = None,
) -> Prepared:
    """Prepare a raw table and write it with its quality report.

    The raw table is read for four things only: the classes, one narrow projection with all
    statistics (cached for the exact medians), the first repaired values, and the grouping of equal rows.
    The grouped rows are written once with the size of each group; duplicate report and label
    summary are one aggregate of that written table.

    ``subset`` are the columns compared for duplicates (all contract columns by
    default) and ``order_by`` decides which copy is the first. A fingerprint
    mismatch is reported and does not stop the job.
    """
    subset = list(subset or spec.columns)
    schema = contract.validate_schema(raw, spec.columns, spec.target, spec.classes)
    run = uuid.uuid4().hex
    table_path, report_path = f"{folder}/table-{run}", f"{folder}/report-{run}"

    cleaned = cleaning.repair_columns(raw, list(spec.grades), spec.max_grade)
    labelled = cleaning.add_targets(
        dedup.group_copies(cleaned, subset, order_by), spec.target, spec.positive, spec.negative
    )
    labelled.write.parquet(table_path)
    written = raw.sparkSession.read.schema(labelled.schema).parquet(table_path)
    table = written.drop(dedup.COPIES)

    sections = {"raw_classes": schema.class_counts}
    if fingerprints is not None:
        sections["source_files"] = fingerprints
    facts = {
        "random_state": F.lit(SEED),
        "n_rows_raw": F.lit(schema.n_rows),
        "n_cols_raw": F.lit(schema.n_cols),
        "schema_ok": F.lit(schema.ok),
        "missing_columns": F.lit(schema.missing_columns).cast("array<string>"),
        "unexpected_classes": F.lit(list(schema.unexpected_classes)).cast("array<string>"),
        "unexpected_columns": F.lit(schema.unexpected_columns).cast("array<string>"),
        "columns": F.array(*[F.lit(c) for c in table.columns]),
        "dtypes": F.array(*[F.lit(kind) for _, kind in table.dtypes]),
    }
    ready = _raw_sections(raw, spec, order_by).crossJoin(_table_sections(written))
    report = write_report(sections, facts, report_path, ready=ready)
    return Prepared(table, report, table_path, report_path)


def _raw_sections(raw: DataFrame, spec: TableSpec, order_by: Sequence[str]) -> DataFrame:
    """One row with an array per report section about the raw table: one aggregate and one count for all of them."""
    grades, limit = [g for g in spec.grades if g in raw.columns], spec.max_grade
    # Repaired once per value, as columns that all sections share.
    after = {g: F.col(f"_after{i}") for i, g in enumerate(grades)}
    staged = raw.withColumns(
        {f"_after{i}": repair_scale(column_as_double(raw, g), limit) for i, g in enumerate(grades)}
    )
    parts = {
        "missing_values": profile.missing_parts(raw, spec.columns),
        "grade_statistics": cleaning.statistics_parts(raw, grades, limit, after),
        "consistency_before": cleaning.consistency_parts(raw, spec.grades),
        "consistency_after": cleaning.consistency_parts(raw, spec.grades, "repaired_violation", after),
    }
    values, aggregates, middles, distribution = cleaning.distribution_parts(raw, grades, limit, after)
    for section_values, section_aggregates, _ in parts.values():
        values, aggregates = values + section_values, aggregates + section_aggregates
    medians, summary = quantiles_and_aggregates(staged.select(*values), middles, aggregates)

    first = cleaning.all_repair_examples(raw, grades, order_by, limit)
    examples: list[list] = [[] for _ in grades]
    for row in sorted(take_bounded(first, 5 * len(grades), "examples"), key=lambda r: r["item"]):
        examples[row["item"]].append(tuple(row)[1:])
    kind = T.ArrayType(T.StructType(first.schema.fields[1:]))
    names = [f"examples_{i + 1}" for i in range(len(grades))]
    shown = raw.sparkSession.createDataFrame([tuple(examples)], T.StructType([T.StructField(n, kind) for n in names]))
    return (
        cleaning.one_row(raw, summary)
        .select(*[rows.alias(name) for name, (_, _, rows) in parts.items()], distribution(medians).alias("distribution"))
        .crossJoin(shown)
    )


def _table_sections(written: DataFrame) -> DataFrame:
    """One row with the duplicate report and the label summary of the written table."""
    labels, rows = cleaning.target_parts(written)
    totals = dedup.copy_totals()
    counted = written.agg(F.struct(*totals).alias("copies"), *labels)
    return counted.select(F.array("copies").alias("duplicates"), rows.alias("targets"))
