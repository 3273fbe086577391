from __future__ import annotations

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from riskmill.functions import durable
from riskmill.operators import cleaning
from riskmill.operators.prepare import prepare_table
from riskmill.sources import fingerprint, reports, tables
from riskmill.students import COLUMNS, STUDENTS, units


@pytest.fixture
def files(tmp_path):
    for name, size in (("a.bin", 10), ("b.bin", 5000), ("c.bin", 0)):
        (tmp_path / name).write_bytes(os.urandom(size))
    return {
        p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(tmp_path.iterdir())
    }


@pytest.mark.parametrize("limit", [10**6, 100, 0])
def test_fingerprints_of_small_and_large_files(spark, tmp_path, files, limit):
    """Files beyond the in-row limit are streamed and give the same digest."""
    got = fingerprint.file_fingerprints(spark, str(tmp_path), in_row_limit=limit).collect()
    assert {os.path.basename(r["path"]): r["actual_sha256"] for r in got} == files


def test_verification(spark, tmp_path, files):
    seen = fingerprint.file_fingerprints(spark, str(tmp_path))
    expected = spark.createDataFrame(
        [(r["path"], "0" * 64 if r["path"].endswith("b.bin") else r["actual_sha256"])
         for r in seen.collect()] + [("file:/gone", "1" * 64)],
        "path string, expected_sha256 string",
    )
    checked = fingerprint.verify_files(spark, str(tmp_path), expected).collect()
    assert {os.path.basename(r["path"]): r["ok"] for r in checked} == {
        "a.bin": True, "b.bin": False, "c.bin": True, "gone": False}


def student_rows(n=40):
    rows = []
    for i in range(n):
        record = {c: 1 if STUDENTS.type_of(c) in ("int", "bigint") else 1.0 for c in COLUMNS}
        record.update({c: "x" for c in COLUMNS if STUDENTS.type_of(c) == "string"})
        record["Target"] = STUDENTS.classes[i % 3]
        record["NotaAdmissao"] = 100.0 + i
        record[units(1, "Grau")] = 13875.0 if i % 2 else 12.5
        record[units(2, "Grau")] = 1.34e16 if i % 4 == 0 else 10.0
        rows.append(tuple(record[c] for c in COLUMNS))
    return rows + [rows[0], rows[0]]


@pytest.fixture
def students(spark):
    return spark.createDataFrame(student_rows(), tables.spec_schema(STUDENTS))


def test_csv_and_parquet_round_trip(spark, students, tmp_path):
    for name in ("t.csv", "t.parquet"):
        path = tables.write_table(students, str(tmp_path / "new" / name))
        back = tables.read_raw_table(spark, path, STUDENTS)
        assert back.schema.simpleString() == students.schema.simpleString()
        assert sorted(back.collect()) == sorted(students.collect())
    with pytest.raises(ValueError, match="schema"):
        tables.read_table(spark, str(tmp_path / "new/t.csv"))


def test_missing_table(spark, tmp_path):
    with pytest.raises(tables.DataNotFoundError):
        tables.read_table(spark, str(tmp_path / "absent.parquet"))


def test_integrity_gate(spark, students, tmp_path):
    path = tables.write_table(students, str(tmp_path / "t.parquet"))
    seen = fingerprint.file_fingerprints(spark, path).select(
        "path", F.col("actual_sha256").alias("expected_sha256"))
    good = spark.createDataFrame(seen.collect(), seen.schema)
    assert tables.read_raw_table(spark, path, STUDENTS, good).count() == 42
    with pytest.raises(tables.IntegrityError):
        bad = good.withColumn("expected_sha256", F.lit("0" * 64))
        tables.read_raw_table(spark, path, STUDENTS, bad)


def test_preparation_job(spark, students, tmp_path):
    raw = students.withColumn("row_id", F.monotonically_increasing_id())
    done = prepare_table(raw, STUDENTS, str(tmp_path), order_by=["row_id"])
    table = done.table
    assert table.count() == 40
    assert set(table.columns) == (set(COLUMNS) - {"Target"}) | {
        "row_id", "target_class", "target", "target_excl_enrolled"}
    assert table.agg(F.max(units(1, "Grau")), F.max(units(2, "Grau"))).first() == (13.875, 13.4)
    report = done.report.first().asDict(recursive=True)
    assert report["n_rows_raw"] == 42 and report["unexpected_columns"] == ["row_id"]
    assert report["duplicates"] == [{
        "n_rows_before": 42, "n_rows_after": 40, "n_rows_in_duplicate_groups": 3,
        "n_duplicate_groups": 1, "n_removed": 2}]
    assert report["missing_values"] == []
    stats = {s["column_name"]: s for s in report["grade_statistics"]}
    assert stats[units(1, "Grau")]["n_corrected"] == 20
    assert all(d["ok"] for d in report["distribution"])
    assert all(c["ok"] for c in report["consistency_before"] + report["consistency_after"])
    classes = {c["Target"]: c["n_rows"] for c in report["raw_classes"]}
    assert classes["Desistente"] == 16  # before duplicates are removed
    main = next(t for t in report["targets"] if t["target"] == "principal")
    assert main["positives"] == 14 and main["total"] == 40
    for i, grade in enumerate((units(1, "Grau"), units(2, "Grau"))):
        alone = [r.asDict() for r in cleaning.repair_examples(raw, grade, ["row_id"]).collect()]
        assert report[f"examples_{i + 1}"] == alone and len(alone) == 5
    document = next((tmp_path.glob("report-*"))).glob("*.json")
    assert json.loads(next(document).read_text())["n_rows_raw"] == 42


def test_metadata_round_trip(spark, tmp_path):
    path = str(tmp_path / "m.json")
    assert reports.read_metadata(spark, path) == {}
    reports.write_metadata(spark, {"limiar": 0.4, "colunas": ["União"]}, path)
    assert reports.read_metadata(spark, path) == {"limiar": 0.4, "colunas": ["União"]}


def test_report_checks_the_size_of_its_sections(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "MAX_SECTION_ROWS", 3)
    with pytest.raises(ValueError, match="big"):
        reports.write_report({"big": spark.range(4)}, {}, str(tmp_path / "r"))


def test_bounded_results(spark):
    assert len(durable.take_bounded(spark.range(3), 3, "rows")) == 3
    with pytest.raises(ValueError, match="rows"):
        durable.take_bounded(spark.range(4), 3, "rows")


def test_intermediate_tables_use_the_session_folder(spark):
    folder = durable.checkpoint_dir(spark)
    df = durable.materialize(spark.range(5).toDF("x"), "five")
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert df.count() == 5 and all(folder in f for f in df.inputFiles())


class Session:
    """Only what the folder lookup asks a session for."""

    def __init__(self, master, folder):
        self.conf = {durable.CHECKPOINT_CONF: folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_checkpoint_folder_of_local_and_cluster_sessions():
    assert durable.checkpoint_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="shared folder"):
        durable.checkpoint_dir(Session("yarn", None))
    local = durable.checkpoint_dir(Session("local[8]", None))
    assert os.path.isdir(local) and local == durable.checkpoint_dir(Session("local[8]", ""))
