"""The pipeline: every stage against a plain version on its own input."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from riskmill.llm import decontamination, toxicity
from riskmill.llm.common import materialize, table
from test_secrets import slow_base
from test_simhash import slow_components, slow_fingerprint


def test_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    columns, held = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder), "test-stage")
        rows = docs.collect()
        if name == "byte-pair encoding":
            ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode_batch(list(held.values()), add_special_tokens=False)
            assert {r.doc_id: r.ids for r in rows} == {d: e.ids for d, e in zip(held, ids)} and all(r.exact for r in rows)
            continue
        assert docs.columns == columns and len({r.doc_id for r in rows}) == len(rows)
        kept = {r.doc_id: r.text for r in rows}
        if name == "toxicity":
            model = toxicity.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
            scores = model.scores(toxicity.Reader(model.odds), list(held.values()))
            assert kept.keys() == {d for d, s in zip(held, scores) if s < 0.5}
        elif name == "simhash near-dedup":
            groups = slow_components({d: slow_fingerprint(t) for d, t in held.items()})
            assert kept.keys() == set(groups.values()) and len(kept) < len(held)
        elif name == "benchmark decontamination":
            items = [f" {' '.join(decontamination.words_of(r.text))} " for r in table(spark, folder, "benchmark").collect()]
            plain = {d: f" {' '.join(decontamination.words_of(t))} " for d, t in held.items()}
            assert held.keys() - kept.keys() == {d for d, t in plain.items() if any(i in t for i in items)}
        else:
            assert kept.keys() == held.keys()
            assert all(not slow_base(t) for t in kept.values())
            assert all(kept[d] == t for d, t in held.items() if not slow_base(t)) and any(kept[d] != t for d, t in held.items())
            assert all(r.n_chars == len(r.text) for r in rows)
        held = kept


def test_pipeline_is_registered():
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and len(corpus_pipeline.STAGES) == 5


def test_null_and_repeated_ids(spark, tmp_path):
    words = lambda name, many=60: " ".join(f"{name}{k}" for k in range(many))
    rows = [(None, words("alone"), 1), (None, words("pair"), 2), (7, words("pair"), 3), (8, words("same"), 4), (8, words("same"), 5),
            (8, words("other"), 6), (None, words("twin"), 7), (None, words("twin"), 8), (None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_key int").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    marks = sorted(r.row_key for r in kept.collect())
    assert kept.columns == docs.columns and len(marks) == 6
    assert {1, 3, 6, 9} < set(marks) and len({4, 5} & set(marks)) == len({7, 8} & set(marks)) == 1
    spark.createDataFrame([(1, words("alone", 30)), (2, words("other", 30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and sorted(r.row_key for r in clean.collect()) == [2, 3, 4, 5, 7, 8, 9]
