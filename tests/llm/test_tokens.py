"""Token files, separator scans and byte-pair encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskmill.llm import byte_bpe, chunks, common, ranked_ids, token_counts
from riskmill.llm.common import new_folder
from riskmill.llm.queries import QUERIES

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "aa", "b", " ", "  ", "\n", "\t", "é", "é", "'s", "'ll", "12", "!!", "<|endoftext|>", "\x1c",
         "\x85", "\xa0", "　", "日本", "😀", "<|endof", "İ", "Σ", "ﬁ", "​", "AbC"]


def library(path: str, texts: list[str], plain: bool = False) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts(count: int) -> list[str]:
    rng = random.Random(5)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(count)]
    return [*made, "", "a" * 3000, " " * 40 + "x", "word " * 40_000]


@pytest.fixture(scope="module")
def texts(spark, small):
    return dict(sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()))


def test_bpe_equals_library():
    texts, bpe = odd_texts(1500), byte_bpe.ByteBpe(BYTE)
    expected, tokenizer = library(BYTE, texts), Tokenizer.from_file(BYTE)
    for text, (ids, decimal), wanted in zip(texts, bpe.encode(texts), expected):
        assert np.frombuffer(ids, "<u4").tolist() == wanted, text
        assert decimal.decode() == ",".join(map(str, wanted))
        assert bpe.decode(ids) == tokenizer.decode(wanted, skip_special_tokens=False)


def test_decode_of_broken_bytes():
    bpe, tokenizer = byte_bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(300) for _ in range(12)]
        assert bpe.decode(np.array(ids, "<u4").tobytes()) == tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, small, texts):
    wanted = library(BYTE, list(texts.values()))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {(i, len(w), digest(",".join(map(str, w))), digest(t)) for (i, t), w in zip(texts.items(), wanted)}
    assert {tuple(r) for r in QUERIES["op5_byte_bpe"](spark, small).collect()} == expected


def test_bpe_rows(spark, table):
    docs = table("doc_id bigint, text string, ids string", (1, None, "x"), (1, "", "y"), (None, "a b", "z"), (2, "a b", "z"))
    rows = byte_bpe.encode_documents(docs, BYTE)
    wanted = library(BYTE, ["a b"])[0]
    assert sorted((r.doc_id or 0, r.ids, r.n_tokens, r.exact) for r in rows.collect()) == [
        (0, wanted, 2, True), (1, [], 0, True), (1, [], 0, True), (2, wanted, 2, True)]
    back = byte_bpe.decode_documents(rows, BYTE)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == [(0, "a b"), (1, ""), (1, ""), (2, "a b")]
    assert byte_bpe.encode_documents(docs.limit(0), BYTE).count() == 0


def test_variable_length_codes():
    values = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1] * 3 + [7], "<u4")
    for count in range(len(values)):
        control, data = ranked_ids.pack(values[:count])
        assert len(control) == -(-count // 4)
        assert ranked_ids.unpack(control, data, count).tolist() == values[:count].tolist()


def stored(texts: dict[int, str]) -> list[tuple]:
    rows, start = [], 0
    for (doc, _), ids in zip(texts.items(), library(WORD, list(texts.values()))):
        ids = ids + [1]
        rows.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_token_files_query(spark, small, texts):
    got = QUERIES["op2_ranked_token_files"](spark, small).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == stored(texts)


def test_token_files_odd_rows(spark):
    texts = dict(enumerate(odd_texts(60)))
    rows = [(i, t or None, 5) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part int").repartition(3)
    folder = new_folder(spark, "test-ids")
    ranked_ids.write_ids(docs, folder, WORD, block_ids=100)
    assert [tuple(r) for r in ranked_ids.stored_documents(spark, folder).orderBy("doc_id").collect()] == stored(texts)
    read = ranked_ids.read_ids(spark, folder).orderBy("part", "number", "place").collect()
    assert [r.doc_id for r in read] == sorted(texts)
    twice = ranked_ids.round_trip(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "doc_id bigint, text string"), WORD)
    assert sorted((r.doc_id, r.start) for r in twice.collect()) == [(1, 0), (1, 2), (2, 4)]
    assert ranked_ids.round_trip(docs.limit(0), WORD).count() == 0
    unnamed = spark.createDataFrame([(5, "b"), (None, "a a"), (None, "a"), (-3, "c")], "doc_id bigint, text string")
    assert [(r.doc_id, r.start) for r in ranked_ids.round_trip(unnamed, WORD).orderBy("start").collect()] == [(None, 0), (None, 2), (-3, 5), (5, 7)]


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(ranked_ids, "FILE_BYTES", 4000)
    monkeypatch.setattr(token_counts, "FILE_BYTES", 4000)
    texts = ["a b c " * (40 if i % 10 else 3000) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(2)
    folder = new_folder(spark, "test-bounds")
    token_counts.write_flat(docs, folder, WORD)
    ranked_ids.write_ids(docs, f"{folder}-ranked", WORD, block_ids=100)
    for at in (folder, f"{folder}-ranked/blocks"):
        sizes = [r.n for r in common.read_blobs(spark, at).selectExpr("length(content) as n").collect()]
        assert len(sizes) > 15 and sum(n > 4002 for n in sizes) <= 10
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, WORD).collect()} == {i: len(t.split()) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in ranked_ids.stored_documents(spark, f"{folder}-ranked").collect()} == {i: len(t.split()) + 1 for i, t in enumerate(texts)}


def test_word_encoder_equals_library():
    texts = odd_texts(3000) + ["The the, THE. don't l'été. ÉTÉ, x1, a.b. ǅ. ß, ﬁn. Straße! 日本. İ. İa, e\u0301. e\u0301t, ΑΣ. ΑΣ,"]
    for plain in (False, True):
        got = chunks.WordEncoder(WORD, plain).encode(texts)
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == library(WORD, texts, plain)


def test_token_counts_query(spark, small, texts):
    got = QUERIES["op4_token_counts"](spark, small).collect()
    wanted = {i: len(w) for i, w in zip(texts, library(WORD, list(texts.values()), plain=True))}
    assert {r.doc_id: r.n_tokens for r in got} == wanted and len(got) == len(wanted)
    starts = sorted((r.part, r.start, r.n_tokens) for r in got)
    for (part, start, size), (other, following, _) in zip(starts, starts[1:]):
        assert following == (start + size + 1 if part == other else 0)


def test_scan_stitches_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "FILE_BYTES", 300)
    texts = odd_texts(80)
    docs = spark.createDataFrame([(i, t or None, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, start string")
    folder = new_folder(spark, "test-flat")
    token_counts.write_flat(docs.coalesce(1), folder, WORD)
    wanted = [len(w) for w in library(WORD, texts, plain=True)]
    for block in (1, 7, 1 << 20):
        found = token_counts.scan_counts(spark, folder, block_ids=block).orderBy("path", "place").collect()
        assert [r.n_tokens for r in found] == wanted
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, WORD).collect()} == dict(enumerate(wanted))
    assert token_counts.token_counts(docs.limit(0), WORD).count() == 0
    same = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(same, WORD).collect()) == [(0, 0), (1, 2), (1, 2)]


def test_unfinished_document_is_reported(spark, tmp_path):
    ids = np.array([5, 6, 49407, 7], "<u2")
    (tmp_path / "part-0").write_bytes(ids.tobytes())
    found = token_counts.scan_counts(spark, str(tmp_path), block_ids=2).collect()
    assert sorted((r.place is None, r.start, r.n_tokens) for r in found) == [(False, 0, 2), (True, 3, 1)]
