"""Benchmark leaks against a plain search, and the numeric parts on their own."""

from __future__ import annotations

import random

import numpy as np

from riskmill.llm import decontamination
from riskmill.llm.decontamination import common_words, words_of
from riskmill.llm.queries import QUERIES


def test_query_finds_whole_passages_only(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: f" {' '.join(words_of(r.text))} " for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: f" {' '.join(words_of(r.text))} " for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    expected = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    got = QUERIES["op9_decontamination"](spark, folder).collect()
    assert expected and {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)
    assert all(r.common == 1.0 for r in got)


def slow_common(a, b) -> int:
    best = [0] * (len(b) + 1)
    for x in a:
        last = best[:]
        for j, y in enumerate(b):
            best[j + 1] = last[j] + 1 if x == y else max(best[j], last[j + 1])
    return best[-1]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (np.array([rng.randrange(5) for _ in range(rng.randrange(1, 90))]) for _ in range(2))
        assert common_words(a, b) == slow_common(a.tolist(), b.tolist())


def sample(rng, count):
    return [f"{rng.choice('bcdfg')}{rng.randrange(4000)}x" for _ in range(count)]


def test_paraphrases_and_edges(spark):
    rng = random.Random(4)
    items = [sample(rng, 30) for _ in range(20)] + [sample(rng, 200)]
    bench = [(i, ". ".join((" ".join(w[: len(w) // 2]), " ".join(w[len(w) // 2 :]))) + ".", "z") for i, w in enumerate(items)]
    bench += [(None, "null id words here", "z"), (50, None, "z"), (51, "", "z")]
    light = [w for k, w in enumerate(items[3]) if k % 6]  # a sixth of the words is left out
    half = items[4][:9] + sample(rng, 12) + items[4][9:12]  # less than half of the item, none of its answer
    long = items[20][:]
    long[::9] = sample(rng, len(long[::9]))
    texts = {0: sample(rng, 500), 1: sample(rng, 77) + items[2] + sample(rng, 300), 2: light, 3: half + sample(rng, 20), 4: items[5] + items[6],
             5: sample(rng, 40) + long}
    rows = [(i, " ".join(t).upper(), 1) for i, t in texts.items()] + [(9, None, 1), (10, "", 1), (None, " ".join(items[0]), 1), (1, "other", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id int")
    table = spark.createDataFrame(bench, "item_id bigint, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, table).collect()}
    assert got == {(1, 2), (2, 3), (4, 5), (4, 6), (5, 20), (None, 0)}
    kept = decontamination.drop_leaks(docs, table).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == [-1, 0, 3, 9, 10] and kept[0].asDict().keys() == {"doc_id", "text", "item_id"}
    assert decontamination.find_leaks(docs.limit(0), table).count() == 0
    assert decontamination.find_leaks(docs, table.limit(0)).count() == 0


def test_axes_keep_most_of_every_item(spark):
    rng = random.Random(6)
    bench = spark.createDataFrame([(i, " ".join(sample(rng, 25))) for i in range(60)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, " ".join(sample(rng, 400))) for i in range(40)], "doc_id bigint, text string")
    loaded = decontamination.load_benchmark(bench)
    sequences = decontamination.term_sequences(docs, loaded.terms)
    found = decontamination.passage_frequencies(sequences, len(loaded.terms))
    idf = np.log((1 + found[-1]) / (1 + found[:-1])) + 1e-3
    axes = decontamination.latent_axes(sequences, loaded, idf, int(found[-1]))
    assert np.allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-3)
    passage, term, count = decontamination._part_cells(loaded)
    rows = np.zeros((len(loaded.parts), len(loaded.terms)))
    rows[passage, term] = decontamination._unit_rows(passage, term, count, idf)
    assert np.linalg.norm(rows @ axes, axis=1).min() > 0.9


def test_item_copied_into_a_third_of_all_texts(spark):
    rng = random.Random(8)
    items = [sample(rng, 30) for _ in range(3)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    rows = [(i, " ".join(items[1] if i % 3 == 0 else sample(rng, 20))) for i in range(10_500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = [(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect()]
    assert len(got) == 3500 and set(got) == {(i, 1) for i in range(0, 10_500, 3)}


def test_part_of_an_item_counts_with_its_answer(spark):
    rng = random.Random(9)
    items = [sample(rng, 40) for _ in range(12)]
    answers = [w[30:] for w in items]
    bench = [(i, " ".join(w), " ".join(a)) for i, (w, a) in enumerate(zip(items, answers))]
    fill = lambda words, keep: [w if k in keep else sample(rng, 1)[0] for k, w in enumerate(words)]
    end = set(range(30, 40))
    found = {
        0: fill(items[0], set(range(12)) | end),  # 55 % of the item, all of its answer
        1: fill(items[1], set(range(20)) | set(range(30, 36))),  # 65 %, 60 % of the answer
        2: fill(items[2], set(range(24)) | set(range(30, 36))),  # 75 %
    }
    clean = {10: fill(items[3], set(range(8)) | end), 11: fill(items[4], set(range(20)) | set(range(30, 35))), 12: sample(rng, 60)}
    rows = [(i, " ".join(sample(rng, 32) + t + sample(rng, 40))) for i, t in {**found, **clean}.items()]
    rows += [(100 + i, " ".join(sample(rng, 200))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame(bench, "item_id bigint, text string, answer string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, table).collect()}
    assert got == {(0, 0), (1, 1), (2, 2)}


def test_item_ids_of_any_type(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "nothing of it here")], "doc_id bigint, text string")
    items = [("a", "one two three four five six seven eight nine ten"), (None, "two three four five six seven eight nine"), ("c", None)]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, item int")
    found = decontamination.find_leaks(docs, benchmark)
    assert dict(found.dtypes)["item_id"] == "string"
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, "a"), (1, None)}
    assert decontamination.find_leaks(docs, benchmark.filter("item_id = 'c'")).count() == 0


def test_products_by_parts(monkeypatch):
    """Every cut of the cells into parts gives the whole product, also one inside the last passage."""
    rng = np.random.default_rng(3)
    passage = np.repeat(np.arange(9) * 2, rng.integers(1, 12, 9))
    term = np.concatenate([rng.choice(40, n, replace=False) for n in np.bincount(passage)[::2]])
    weight = rng.random(len(term)).astype(np.float32)
    matrix = rng.standard_normal((40, 6)).astype(np.float32)
    whole = np.zeros((18, 40))
    whole[passage, term] = weight
    for step in range(1, len(term) + 2):
        monkeypatch.setattr(decontamination, "STEP", step)
        out = np.zeros((40, 6))
        decontamination._multiply(passage, term, weight, matrix, out)
        np.testing.assert_allclose(out, whole.T @ (whole @ matrix), rtol=1e-4, atol=1e-5)


def test_absent_terms_settle_candidates_alike(monkeypatch):
    """The bound by absent terms leaves out no match that the subsequence accepts."""
    rng = random.Random(8)
    bench = decontamination.Benchmark()
    items = [sample(rng, 24) for _ in range(6)]
    for i, words in enumerate(items):
        bench.add(i, " ".join(words), " ".join(words[-4:]))
    sequences = []
    for words in items * 20:
        kept = [w if rng.random() < rng.choice((0.45, 0.55, 0.8, 1.0)) else "other" for w in words]
        sequences.append(np.array([bench.terms.get(w, -1) for w in sample(rng, rng.randrange(50)) + kept], np.int32))
    search = decontamination._Search(bench, np.eye(len(bench.terms), dtype=np.float32), np.ones(len(bench.terms), np.float32), None, 0.0)
    near = [(r, p, q, 0.5) for r, s in enumerate(sequences) for p in range(-(-len(s) // decontamination.PASSAGE)) for q in range(6)]
    monkeypatch.setattr(search, "candidates", lambda _: near)
    expected = {}
    for r, p, q, _ in near:
        start = max(0, p * decontamination.PASSAGE - len(bench.items[q]))
        around = sequences[r][start : (p + 2) * decontamination.PASSAGE + len(bench.items[q])]
        common = slow_common(bench.items[q].tolist(), around.tolist()) / len(bench.items[q])
        told = slow_common(bench.answers[q].tolist(), around.tolist()) / len(bench.answers[q])
        if common >= decontamination.SURE or common >= decontamination.POSSIBLE and told >= decontamination.ANSWER:
            expected[r, q] = max(common, expected.get((r, q), 0))
    assert expected and {(r, m[0]): m[3] for r, m in search.matches(sequences)} == expected
