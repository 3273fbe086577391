"""Exact duplicates against plain grouping."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from riskmill.llm import exact_dedup


def normal(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, keep, len(ids), sha) for i in ids]
    return sorted(found, key=repr)


ROWS = [(3, None), (1, ""), (None, ""), (7, "Ä same"), (8, "Ä SAME"), (9, "ä same"), (5, "twice"), (5, "twice"), (None, "alone"),
        (None, "x"), (None, "x"), (20, "long " * 20_000), (21, "LONG " * 20_000), *((i, "hot copy") for i in range(100, 160))]


@pytest.mark.parametrize("bits", [1 << 28, exact_dedup.BITMAP // 64])
def test_groups_and_slices(spark, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", bits)
    docs = spark.createDataFrame([(i, t, 1, "a") for i, t in ROWS], "doc_id bigint, text string, slot0 int, sha string").repartition(3)
    got = exact_dedup.find_copies(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == expected(ROWS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((normal(r.text), r.doc_id or 0) for r in left.collect()) == sorted(
        {normal(t): max([i or 0 for i, o in ROWS if normal(o) == normal(t)]) for _, t in ROWS}.items())
    assert exact_dedup.find_copies(docs.limit(0)).count() == 0 == exact_dedup.drop_copies(docs.limit(0)).count()


def test_filter_lets_single_texts_pass(spark):
    texts = [(i, f"text {i if i % 10 else 0}") for i in range(5000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    digests = docs.select(exact_dedup.text_digest().alias("sha"))
    filter_ = exact_dedup.Repeats(digests, "sha")
    alone, maybe = filter_.split(digests, digests["sha"])
    assert alone.count() + maybe.count() == 5000 and 500 <= maybe.count() < 700


def test_no_python_and_no_shuffle_of_single_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = exact_dedup.drop_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    filter_ = exact_dedup.Repeats(docs.select(exact_dedup.text_digest().alias("sha")), "sha")
    alone, _ = filter_.split(docs, exact_dedup.text_digest())
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Exchange range" not in plan and "Exchange Single" not in plan
