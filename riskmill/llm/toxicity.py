"""Toxicity scores of whole texts by a bidirectional gated recurrent network.

Words enter as evidence that was counted on labelled training rows: the smoothed log odds of the word itself,
and the largest ones of its character 3-, 4- and 5-grams (with marks for its ends), so that new forms of
a known stem are seen. The network (``gru.py``) reads windows of 48 words, every 32 words a new one, and a
text's score is that of its most toxic window. Labels, language, source and doc_id are no inputs.

Fitting is bounded: ``MAX_FIT_ROWS`` labelled rows, chosen by a hash of their doc_id, whatever the
table's size. Scoring reads all of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.durable import take_bounded
from riskmill.llm import gru
from riskmill.llm.common import materialize, plain, unused

#: Labelled rows that the evidence and the network are fitted on, at most.
MAX_FIT_ROWS = 16_000
#: Words and n-grams with evidence, at most.
MAX_EVIDENCE = 200_000
WINDOW, STRIDE = 48, 32
GRAMS = (3, 4, 5)
HIDDEN, EPOCHS = 8, 8
#: Pseudo-documents that draw rare evidence to zero, the least evidence kept, its least toxic rows.
SMOOTHING, LEAST_ODDS, LEAST_ROWS = 5.0, 1.5, 4
MAX_WORDS = 500_000

find_words = re.compile(r"[^\W_]+").findall


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def grams_of(word: str) -> list[str]:
    """Character n-grams of a word with marks for its ends."""
    marked = f"<{word}>"
    return [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]


def _evidence_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(find_words((text or "").lower()))
            found = set(words)
            for word in words:
                found.update(f"#{g}" for g in grams_of(word))
            (toxic if label else clean).update(found)
    names = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())],
        ["name", "toxic", "clean"],
    )


def evidence(rows: DataFrame) -> dict[str, float]:
    """Log odds of words, and of n-grams under ``#`` names, from (text, toxic): only those that speak for toxic."""
    total = take_bounded(rows.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")), 1, "label counts")[0]
    toxic, count = total.t or 0, total.n
    if not 0 < toxic < count:
        return {}
    share = toxic / count
    counted = rows.select("text", "toxic").mapInArrow(_evidence_counts, "name string, toxic bigint, clean bigint")
    summed = counted.groupBy("name").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    odds = F.log((F.col("t") + SMOOTHING * share) / (F.col("c") + SMOOTHING * (1 - share)) * ((1 - share) / share))
    kept = summed.filter(F.col("t") >= LEAST_ROWS).select("name", odds.alias("odds")).filter(F.col("odds") >= LEAST_ODDS)
    return {r.name: float(r.odds) for r in take_bounded(kept, MAX_EVIDENCE, "evidence")}


class Reader:
    """Texts to windows of inputs, each distinct word looked up once per worker."""

    def __init__(self, odds: dict[str, float]):
        self.words = {k: v for k, v in odds.items() if k[0] != "#"}
        self.grams = {k[1:]: v for k, v in odds.items() if k[0] == "#"}
        self.rows: dict[str, int] = {}
        self.found: list[np.ndarray] = [np.zeros(1 + len(GRAMS), np.float32)]
        self.stacked = np.stack(self.found)

    @property
    def table(self) -> np.ndarray:
        """The inputs of every known row."""
        if len(self.stacked) < len(self.found):
            self.stacked = np.concatenate([self.stacked, np.stack(self.found[len(self.stacked) :])])
        return self.stacked

    def _row(self, word: str) -> int:
        found = [self.words.get(word, 0.0)]
        marked, get = f"<{word}>", self.grams.get
        for n in GRAMS:
            found.append(max([get(marked[i : i + n], 0.0) for i in range(len(marked) - n + 1)], default=0.0))
        if not any(found):
            return 0
        self.found.append(np.array(found, np.float32) / 5)
        return len(self.found) - 1

    def codes(self, text: str) -> np.ndarray:
        """A row of ``table`` for every word; row 0 is a word without evidence."""
        words = find_words(text.lower())
        if len(self.rows) > MAX_WORDS:
            self.rows, self.found = {}, self.found[:1]
            self.stacked = np.stack(self.found)
        rows = self.rows
        for word in set(words):
            if word not in rows:
                rows[word] = self._row(word)
        return np.fromiter(map(rows.__getitem__, words), np.int64, len(words))

    def windows(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(windows, WINDOW) codes, and the number of words in each; a text without words is one empty window."""
        codes = self.codes(text)
        many = 1 + max(0, -(-(len(codes) - WINDOW) // STRIDE))
        padded = np.zeros((many - 1) * STRIDE + WINDOW, np.int64)
        padded[: len(codes)] = codes
        starts = np.arange(many) * STRIDE
        return padded[starts[:, None] + np.arange(WINDOW)], np.minimum(len(codes) - starts, WINDOW)

    def inputs(self, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(steps, rows, features) and the mask; an empty window has one real step without evidence."""
        x = self.table[windows.T]
        mask = (np.arange(WINDOW)[:, None] < np.maximum(sizes, 1)).astype(np.float32)
        return x, mask


@dataclass
class Toxicity:
    """A fitted model: evidence and network weights, both small and sent to every task."""

    odds: dict[str, float]
    weights: gru.Weights | None

    def window_logits(self, reader: Reader, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One logit per window. Windows without any evidence differ in length alone: one of each length is run."""
        out = np.empty(len(windows), np.float32)
        bare = ~windows.any(axis=1)
        _, first, back = np.unique(sizes[bare], return_index=True, return_inverse=True)
        places = np.flatnonzero(bare)[first]
        run = np.concatenate([np.flatnonzero(~bare), places])
        for at in range(0, len(run), 2048):
            rows = run[at : at + 2048]
            out[rows] = gru.logits(self.weights, *reader.inputs(windows[rows], sizes[rows]))
        out[bare] = out[places][back]
        return out

    def scores(self, reader: Reader, texts: list[str]) -> list[float]:
        """Probability of the most toxic window of each text."""
        if self.weights is None:
            return [0.0] * len(texts)
        scored = []
        held, counts = [], []

        def run() -> None:
            if held:
                found = self.window_logits(reader, np.concatenate([w for w, _ in held]), np.concatenate([s for _, s in held]))
                starts = np.cumsum([0, *counts[:-1]])
                scored.extend((1 / (1 + np.exp(-np.maximum.reduceat(found, starts).astype(np.float64)))).tolist())
                held.clear()
                counts.clear()

        size = 0
        for text in texts:
            if size > 8192 or len(reader.rows) > MAX_WORDS:
                run()
                size = 0
            windows, sizes = reader.windows(text)
            held.append((windows, sizes))
            counts.append(len(sizes))
            size += len(sizes)
        run()
        return scored


def _training_windows(odds: dict[str, float]):
    """Of each text the window with the most evidence, and of clean texts another one as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(odds)
        for batch in batches:
            raw, sizes, labels = [], [], []
            for doc, text, label in zip(*(c.to_pylist() for c in batch.columns)):
                windows, size = reader.windows(text or "")
                table = reader.table
                weight = table[windows].sum(axis=(1, 2))
                chosen = {int(weight.argmax())}
                if not label:
                    chosen.add((doc or 0) % len(size))
                for i in sorted(chosen):
                    raw.append(table[windows[i]].astype("<f4").tobytes())
                    sizes.append(max(1, int(size[i])))
                    labels.append(int(label))
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw, pa.binary()), pa.array(sizes, pa.int32()), pa.array(labels, pa.int32())], ["x", "size", "y"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Toxicity:
    """Fit on at most ``max_rows`` labelled documents that are not held out.

    Rows without label or doc_id are left out, of a doc_id labelled twice the larger label counts. Labels
    of one class only, or none, give a model that scores 0 everywhere.
    """
    marked = plain(labels, "doc_id", "toxic").filter("doc_id is not null and toxic is not null").filter(~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = materialize(plain(docs, "doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "toxic"), "fit")
    odds = evidence(rows)
    if not odds:
        return Toxicity({}, None)
    picked = rows.mapInArrow(_training_windows(odds), "x binary, size int, y int").toPandas()
    # Tasks may deliver their windows in any order; a fixed one makes the fit repeatable.
    picked = picked.sort_values(["y", "size", "x"])
    x = np.stack([np.frombuffer(r, "<f4").reshape(WINDOW, -1) for r in picked["x"]]).transpose(1, 0, 2)
    mask = (np.arange(WINDOW)[:, None] < picked["size"].to_numpy()).astype(np.float32)
    return Toxicity(odds, gru.train(x, mask, picked["y"].to_numpy().astype(np.float32), HIDDEN, EPOCHS))


def score_documents(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text); null and empty texts are one empty window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.odds)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = model.scores(reader, [t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return plain(docs, "doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of ``docs``, without rows that the model fitted on ``labels`` calls toxic."""
    model = fit(docs, labels)
    wide = docs.withColumn(unused(docs, 1)[0], F.col("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.odds)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = model.scores(reader, [t or "" for t in part.column(part.num_columns - 1).to_pylist()])
                kept = part.filter(pa.array([s < 0.5 for s in found]))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])

    return wide.mapInArrow(run, schema)
