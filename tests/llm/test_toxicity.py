"""The network against finite differences, and the whole on held-out labels."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmill.llm import gru, toxicity
from riskmill.llm.queries import QUERIES


def test_gradients():
    rng = np.random.default_rng(0)
    weights = {k: rng.standard_normal(v.shape) * 0.7 for k, v in gru.new_weights(3, 4).items()}
    x, y = rng.standard_normal((6, 5, 3)), np.array([0, 1, 1, 0, 1.0])
    mask = (np.arange(6)[:, None] < np.array([6, 1, 3, 5, 2])).astype(float)
    _, grads = gru.loss_and_gradients(weights, x, mask, y)
    for name, value in weights.items():
        for _ in range(6):
            at = tuple(rng.integers(n) for n in value.shape)
            losses = []
            for move in (1e-5, -1e-5):
                value[at] += move
                losses.append(gru.loss_and_gradients(weights, x, mask, y)[0])
                value[at] -= move
            assert abs((losses[0] - losses[1]) / 2e-5 - grads[name][at]) < 1e-6, name


def test_masked_steps_do_not_count():
    weights = gru.new_weights(3, 4)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((8, 2, 3)).astype(np.float32)
    mask = (np.arange(8)[:, None] < np.array([5, 8])).astype(np.float32)
    assert np.allclose(gru.logits(weights, x, mask)[0], gru.logits(weights, x[:5, :1], mask[:5, :1])[0], atol=1e-5)


def area(scores: list[float], labels: list[int]) -> float:
    good = [s for s, y in zip(scores, labels) if y]
    bad = [s for s, y in zip(scores, labels) if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


@pytest.fixture(scope="module")
def model(spark):
    folder = "/root/testdata/sf0.1"
    return toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    out = QUERIES["op3_toxicity"](spark, folder).collect()
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    assert area(*map(list, zip(*held))) > 0.7  # fitted on some forty toxic texts


def test_held_out_accuracy(spark, model):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held = docs.join(labels.filter(toxicity.held_out()), "doc_id").select("text", "toxic").collect()
    scores = model.scores(toxicity.Reader(model.odds), [r.text for r in held])
    truth = [r.toxic for r in held]
    assert area(scores, truth) > 0.9
    assert sum((s >= 0.5) == bool(y) for s, y in zip(scores, truth)) / len(truth) > 0.95


def test_labels_and_source_are_no_inputs(spark, model):
    docs = spark.createDataFrame([(1, "you idiot and scum", "en"), (2, "you idiot and scum", "fr"), (2, None, "x"), (None, "", "x")],
                                 "doc_id bigint, text string, score string")
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == 4 and rows[0].score == rows[1].score > 0.5 > rows[2].score == rows[3].score
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_every_window_counts(model):
    reader = toxicity.Reader(model.odds)
    neutral = next(w for w in ("bread", "xylem", "quux", "zzzz") if not reader.codes(w).any())
    calm = " ".join([neutral] * 400)
    for at in (0, 200, 399):
        parts = calm.split()
        parts[at:at] = ["idiot", "and", "scum"]
        hot, cold = model.scores(reader, [" ".join(parts), calm])
        assert hot > 0.5 > cold
    windows, sizes = reader.windows(calm)
    covered = set()
    for i, size in enumerate(sizes):
        covered |= set(range(i * toxicity.STRIDE, i * toxicity.STRIDE + size))
    assert covered == set(range(400)) and windows.shape[1] == toxicity.WINDOW


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "idiot")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity.toxicity_report(docs, labels).collect()] == [0.0]
    assert toxicity.keep_clean(docs.withColumn("toxic", F.lit(1)), labels).columns == ["doc_id", "text", "toxic"]
    odd = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    assert toxicity.toxicity_report(docs, odd).count() == 1


def test_keep_clean_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x", "y"), (None, None, None, "z")], "doc_id bigint, text string, _text string, slot0 string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))
