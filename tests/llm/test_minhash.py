"""One-permutation MinHash against exact similarities."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from riskmill.llm import minhash
from riskmill.llm.queries import QUERIES


def shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def edited(texts: dict[int, str]) -> dict[int, str]:
    ids = sorted(texts, reverse=True)
    out = {}
    for n, i in enumerate(ids):
        text, following = texts[i], texts[ids[(n + 1) % len(ids)]]
        cut = len(text) // 3
        out[i] = text[: len(text) - cut] + following[:cut]
    return out


@pytest.fixture(scope="module")
def report(spark, small):
    rows = QUERIES["op8_minhash_fingerprints"](spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    return {r.doc_id: r for r in rows}, texts


def test_query_texts(report):
    rows, texts = report
    assert set(rows) == set(texts)
    for i, text in edited(texts).items():
        assert rows[i].n_chars == len(texts[i])
        assert rows[i].edited_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_query_likeness(report):
    rows, texts = report
    changed, ids, errors = edited(texts), sorted(texts, reverse=True), []
    for n, i in enumerate(ids):
        own = shingles(texts[i])
        for other, near in ((changed[i], rows[i].near_edited), (texts[ids[(n + 1) % len(ids)]], rows[i].near_next)):
            there = shingles(other)
            errors.append(near - len(own & there) / len(own | there))
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.06
    assert abs(sum(errors) / len(errors)) < 0.01


def test_edge_rows(spark):
    rows = [(1 << 13, "same words here for both of them"), (5, "same words here for both of them"), (4, None), (3, "  "), (-9, "tiny one"),
            (2, "tiny ONE"), (2, "tiny ONE"), (None, "abc")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("bucket", F.lit("x")).withColumn("bins", F.lit(1))
    out = minhash.edited_report(docs).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[1 << 13].fingerprint == by[5].fingerprint and by[1 << 13].near_next == 1.0
    assert by[4].fingerprint == "" == by[3].fingerprint and by[4].near_next == 1.0 and by[3].near_next == 0.0
    assert by[2].fingerprint == by[-9].fingerprint and len(by[2].fingerprint) == 256
    first = "tiny one"[: 8 - 2] + "sa"
    assert by[-9].edited_sha256 == hashlib.sha256(first.encode()).hexdigest()
    assert by[None].near_next is None and by[None].n_chars == 3
    assert minhash.edited_report(docs.limit(0)).count() == 0


def test_likeness_over_the_range(spark):
    words = [f"w{i}" for i in range(600)]
    texts = [" ".join(words[s : s + 300]) for s in range(0, 300, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bins = minhash.fingerprint_documents(docs)
    base = bins.filter("doc_id = 0").select(F.col("bins").alias("base"))
    near = {r.doc_id: r.near for r in bins.join(F.broadcast(base)).select("doc_id", minhash.likeness(F.col("base"), F.col("bins")).alias("near")).collect()}
    for i, text in enumerate(texts):
        a, b = shingles(texts[0]), shingles(text)
        assert abs(near[i] - len(a & b) / len(a | b)) < 0.13
    assert near[0] == 1.0


def test_no_python_in_the_plan(spark, small, capsys):
    QUERIES["op8_minhash_fingerprints"](spark, small).explain()
    QUERIES["op10_secret_scans"](spark, small).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan
