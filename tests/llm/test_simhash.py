"""SimHash groups against brute force."""

from __future__ import annotations

import re

import pytest
import xxhash
from pyspark.sql import functions as F

from riskmill.llm import simhash
from riskmill.llm.components import components
from riskmill.llm.queries import QUERIES


def slow_fingerprint(text: str) -> int:
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_components(marks: dict[int, int], distance: int = 2) -> dict[int, int]:
    root = {i: i for i in marks}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(marks)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (marks[a] ^ marks[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    marks = {i: slow_fingerprint(t) for i, t in texts.items()}
    expected = {(i, f"{marks[i]:016x}", c) for i, c in slow_components(marks).items()}
    got = QUERIES["op1_simhash_near_dedup"](spark, small).select("doc_id", "fingerprint", "component_id").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(texts)


def test_edge_texts(spark, table):
    rows = [(3, None, "x"), (1, "", "y"), (2, " \t\n", "z"), (5, "one two", "x"), (4, "ONE\x0btwo", "x"), (4, "ONE\x0btwo", "x"),
            (9, "É a b c", "q")]
    docs = table("doc_id bigint, text string, fp string", *rows)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).collect()}
    zero = "0" * 16
    two, nine = f"{slow_fingerprint('one two'):016x}", f"{slow_fingerprint('É a b c'):016x}"
    assert got == {(3, zero, 1), (1, zero, 1), (2, zero, 1), (5, two, 4), (4, two, 4), (9, nine, 9)}
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("paired", [2, 32])
def test_full_blocks_lose_no_link(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    base, marks = 0x9E3779B97F4A7C15, set()
    for i in range(0, 60, 3):
        marks |= {base ^ 1 << i, base ^ 1 << i ^ 1 << (i + 1), base ^ 7 << i}
    marks = dict(enumerate(sorted(marks)))
    nodes = spark.createDataFrame([(m - (1 << 64) if m >> 63 else m,) for m in marks.values()], "fp bigint")
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in components(simhash.link_fingerprints(nodes)).collect()}
    slow = slow_components(marks)
    groups = lambda pairs: {frozenset(a for a, b in pairs if b == r) for _, r in pairs}
    mine = groups([(m, roots.get(m, m)) for m in marks.values()])
    assert mine == groups([(marks[a], marks[b]) for a, b in slow.items()])


def test_components_of_a_chain(spark):
    links = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = components(links.union(spark.createDataFrame([(900, 900), (700, 800)], "a bigint, b bigint"))).collect()
    roots = {r.node: r.root for r in rows}
    assert all(roots[i] == 0 for i in range(501)) and roots[700] == roots[800] == 700


def test_one_row_of_each_group_stays(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    heads = {r.component_id for r in simhash.simhash_groups(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(heads)
    rows = [(None, "a b c d", 1), (None, "a b c d", 2), (4, "x y z", 3), (4, "X Y z", 4), (3, "x y  z", 5), (9, None, 6), (None, "", 7)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, row_key int").repartition(3)
    left = sorted((r.doc_id or 0, r.row_key) for r in simhash.keep_one(frame).collect())
    assert len(left) == 3 and left[1:] == [(3, 5), (9, 6)] and left[0][1] in (1, 2)
    assert simhash.keep_one(frame.limit(0)).count() == 0
