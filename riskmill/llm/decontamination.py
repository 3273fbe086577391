"""Benchmark passages in documents, found by latent semantic retrieval and checked word by word.

1. Texts become sequences of the benchmark's terms (other words keep their place).
2. Passage frequencies of the terms are counted over all documents; passages of 32 words and the
   benchmark's own are TF-IDF rows of unit length.
3. A randomised SVD of these rows: every task multiplies its rows with a fixed random matrix
   and back, the sums are added up by term, and one small decomposition (Nystroem) gives the latent axes. The
   benchmark's rows together weigh as much as the corpus, or rare terms would fall out of the leading axes.
4. Every window of two passages is compared with every benchmark passage by the cosine of
   their latent vectors.
5. A candidate counts if the longest common subsequence of the item's words and the words around the window
   covers most of the item, or a smaller part together with the item's answer (its answer column, else its last sentence).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskmill.functions.durable import take_bounded
from riskmill.llm.common import materialize, plain, with_row_key

PASSAGE = 32
#: A benchmark item is searched by parts of so many words.
QUERY_WORDS = 48
RANK = 128
COSINE = 0.35
SURE, POSSIBLE, ANSWER = 0.75, 0.5, 0.6
#: Bounds of what is sent to every task: items and terms of one benchmark table.
MAX_ITEMS, MAX_TERMS = 50_000, 500_000
#: Matrix entries handled at once, in a dense part of at most as many rows and columns.
STEP = 1 << 11

find_words = re.compile(r"[^\W_]+").findall


def words_of(text: str | None) -> list[str]:
    return find_words((text or "").lower())


@dataclass
class Benchmark:
    """Items as term numbers, the parts they are searched by, and their answers."""

    item_ids: list = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    answers: list[np.ndarray] = field(default_factory=list)
    parts: list[np.ndarray] = field(default_factory=list)
    part_item: list[int] = field(default_factory=list)
    terms: dict[str, int] = field(default_factory=dict)

    def add(self, item_id, text: str | None, answer: str | None) -> None:
        words = words_of(text)
        if not words:
            return
        number = lambda ws: np.array([self.terms.setdefault(w, len(self.terms)) for w in ws], np.int32)
        if answer is None:
            sentences = [s for s in re.split(r"[.!?]+(?:\s|$)", text) if words_of(s)]
            answer = sentences[-1] if sentences else text
        ids, last = number(words), len(self.items)
        self.item_ids.append(item_id)
        self.items.append(ids)
        self.answers.append(number(words_of(answer)))
        for at in range(0, len(ids), QUERY_WORDS):
            # A short rest is searched together with the words before it.
            start = max(0, min(at, len(ids) - QUERY_WORDS))
            self.parts.append(ids[start : start + QUERY_WORDS])
            self.part_item.append(last)


def load_benchmark(benchmark: DataFrame) -> Benchmark:
    """The benchmark (item_id, text, answer if there is one) on the driver, bounded by ``MAX_ITEMS``."""
    has_answer = "answer" in benchmark.columns
    columns = ["item_id", "text", *(["answer"] if has_answer else [])]
    loaded = Benchmark()
    rows = take_bounded(plain(benchmark, *columns).distinct(), MAX_ITEMS, "benchmark items")
    for row in sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.text or "")):
        loaded.add(row.item_id, row.text, row.answer if has_answer else None)
    if len(loaded.terms) > MAX_TERMS:
        raise ValueError(f"benchmark terms: more than {MAX_TERMS}")
    return loaded


def term_sequences(docs: DataFrame, terms: dict[str, int]) -> DataFrame:
    """(doc_id, terms): every word's term number as little-endian int32, -1 for other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = terms.get
        for batch in batches:
            out = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                out.append(np.fromiter(map(get, words, repeat(-1)), "<i4", len(words)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "terms"])

    return plain(docs, "doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, terms binary")


def _grouped(batch: pa.RecordBatch, column: int, most: int = 1 << 18) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sequences) in groups of about ``most`` words."""
    held, size, first = [], 0, 0
    for i, raw in enumerate(batch.column(column)):
        held.append(np.frombuffer(raw.as_buffer(), "<i4"))
        size += len(held[-1])
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _cells(sequences: list[np.ndarray], terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, count) of the occupied cells in passage order, and the first passage of each sequence."""
    sizes = np.array([-(-len(s) // PASSAGE) for s in sequences], np.int64)
    first = np.cumsum(sizes) - sizes
    flat = np.concatenate(sequences)
    place = np.concatenate([np.arange(len(s)) // PASSAGE + f for s, f in zip(sequences, first)])
    known = flat >= 0
    cell, count = np.unique(place[known] * terms + flat[known], return_counts=True)
    return cell // terms, cell % terms, count, first


def passage_frequencies(sequences: DataFrame, terms: int) -> np.ndarray:
    """Number of passages with each term, and at the end the number of all passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms + 1, np.int64)
        for batch in batches:
            for _, group in _grouped(batch, 0):
                _, term, _, _ = _cells(group, terms)
                found[:terms] += np.bincount(term, minlength=terms)
                found[terms] += sum(-(-len(s) // PASSAGE) for s in group)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], ["term", "n"])

    rows = sequences.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(terms + 1, np.int64)
    for row in take_bounded(rows, MAX_TERMS + 1, "terms"):
        found[row.term] = row.n
    return found


def _unit_rows(passage: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of the cells, every passage of length one."""
    weight = (1 + np.log(count)) * idf[term]
    starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    norms = np.sqrt(np.add.reduceat(weight * weight, starts))
    return (weight / np.repeat(norms, np.diff(np.append(starts, len(passage))))).astype(np.float32)


def _dense_parts(passage, term, weight) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(passages, terms, weights) of whole passages in parts of about ``STEP`` cells: dense, with the part's own terms only."""
    starts = np.append(np.flatnonzero(np.append(True, passage[1:] != passage[:-1])), len(passage))
    cuts = starts[np.searchsorted(starts, np.arange(0, len(passage), STEP))]
    for low, high in zip(cuts, np.append(cuts[1:], len(passage))):
        if low < high:
            rows, row = np.unique(passage[low:high], return_inverse=True)
            used, at = np.unique(term[low:high], return_inverse=True)
            dense = np.zeros((len(rows), len(used)), np.float32)
            dense[row, at] = weight[low:high]
            yield rows, used, dense


def _multiply(passage, term, weight, matrix: np.ndarray, out: np.ndarray) -> None:
    """Add ``rows.T @ (rows @ matrix)`` to ``out`` for whole passages, a bounded part at a time."""
    for _, used, dense in _dense_parts(passage, term, weight):
        out[used] += dense.T @ (dense @ matrix[used])


def random_matrix(terms: int, rank: int) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((terms, rank)).astype(np.float32)


def _corpus_product(sequences: DataFrame, terms: int, idf: np.ndarray, rank: int) -> np.ndarray:
    """``rows.T @ rows @ random`` over all passages; partial sums are added by blocks of terms."""
    block = 256

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, out = random_matrix(terms, rank), np.zeros((terms, rank))
        group = TaskContext.get().partitionId() % TASK_GROUPS
        for batch in batches:
            for _, sequences_ in _grouped(batch, 0):
                passage, term, count, _ = _cells(sequences_, terms)
                if len(passage):
                    _multiply(passage, term, _unit_rows(passage, term, count, idf), matrix, out)
        for at in range(0, terms, block):
            part = out[at : at + block]
            if part.any():
                raw = pa.array([part.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([group], pa.int32()), raw], ["at", "tasks", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for *key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found, key = np.frombuffer(part.as_buffer(), np.float64), tuple(key)
                sums[key] = sums[key] + found if key in sums else found
        names = [pa.array([k[i] for k in sums], kind) for i, kind in enumerate((pa.int64(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*names, pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["at", "tasks", "part"])

    # Two levels, so that no task adds up the parts of all tasks: by group of tasks, then over the groups.
    ddl = "at bigint, tasks int, part binary"
    sums = sequences.select("terms").mapInArrow(multiply, ddl).repartition("at", "tasks").mapInArrow(add, ddl)
    sums = sums.withColumn("tasks", F.lit(0)).repartition("at").mapInArrow(add, ddl)
    out = np.zeros((terms, rank))
    for row in take_bounded(sums, MAX_TERMS // block + 1, "blocks of terms"):
        part = np.frombuffer(row.part, np.float64).reshape(-1, rank)
        out[row.at : row.at + len(part)] = part
    return out


def latent_axes(sequences: DataFrame, bench: Benchmark, idf: np.ndarray, passages: int, rank: int = RANK) -> np.ndarray:
    """(terms, rank): leading right singular vectors of the corpus and benchmark rows."""
    terms = len(bench.terms)
    rank = min(rank, terms)
    product = _corpus_product(sequences, terms, idf, rank)
    passage, term, count = _part_cells(bench)
    own = np.zeros((terms, rank))
    matrix = random_matrix(terms, rank)
    _multiply(passage, term, _unit_rows(passage, term, count, idf), matrix, own)
    product += own * (max(1, passages) / len(bench.parts))
    # Nystroem: G ~ Y (R' Y)^-1 Y', so G's leading vectors are the left ones of Y L^-T.
    shift = 1e-9 * np.linalg.norm(product)
    shifted = product + shift * matrix
    middle = matrix.T.astype(np.float64) @ shifted
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    keep = values > values[-1] * 1e-12
    half = shifted @ (vectors[:, keep] / np.sqrt(values[keep]))
    return np.linalg.svd(half, full_matrices=False)[0].astype(np.float32)


def _part_cells(bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    terms = len(bench.terms)
    place = np.repeat(np.arange(len(bench.parts)), [len(p) for p in bench.parts])
    cell, count = np.unique(place * terms + np.concatenate(bench.parts), return_counts=True)
    return cell // terms, cell % terms, count


def common_words(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, with one bit per word of the item."""
    where: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        where[word] = where.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in text.tolist():
        hit = where.get(word)
        if hit:
            met = row & hit
            row = (row + met | row - met) & full
    return len(item) - row.bit_count()


#: Groups of tasks whose sums are added first.
TASK_GROUPS = 64
MATCH_DDL = "item int, start int, cosine double, common double, answer double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id, start, cosine, common, answer): benchmark items that documents contain.

    One row per document row and item, at its best place: ``start`` is a word position, ``common`` and ``answer``
    the shares of the item's and its answer's words found there in order. Null or empty texts and items have
    no words and match nothing; null doc_ids and repeated rows stay, item_ids may be of any type or null. Whole texts are searched.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    ddl = f"doc_id {kind}, {MATCH_DDL}"
    bench = load_benchmark(benchmark)
    terms = len(bench.terms)
    if not terms:
        return spark.createDataFrame([], ddl).join(_named_items(spark, bench, benchmark), "item").select(*MATCH_COLUMNS)
    sequences = materialize(term_sequences(docs, bench.terms), "terms")
    found = passage_frequencies(sequences, terms)
    passages = int(found[-1])
    idf = np.log((1 + passages) / (1 + found[:-1])) + 1e-3
    axes = latent_axes(sequences, bench, idf, passages)
    passage, term, count = _part_cells(bench)
    queries = np.zeros((len(bench.parts), axes.shape[1]), np.float32)
    np.add.at(queries, passage, axes[term] * _unit_rows(passage, term, count, idf)[:, None])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    search = _Search(bench, axes, idf.astype(np.float32), queries, cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matches = [], []
            for first, group in _grouped(batch, 1):
                for row, match in search.matches(group):
                    rows.append(first + row)
                    matches.append(match)
            columns = list(zip(*matches)) if matches else [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "item", "start", "cosine", "common", "answer"],
            )

    return sequences.mapInArrow(run, ddl).join(_named_items(spark, bench, benchmark), "item").select(*MATCH_COLUMNS)


MATCH_COLUMNS = ("doc_id", "item_id", "start", "cosine", "common", "answer")


def _named_items(spark: SparkSession, bench: Benchmark, benchmark: DataFrame) -> DataFrame:
    """(item, item_id): ids of the items by number, at most ``MAX_ITEMS`` rows, so they are broadcast."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", benchmark.schema["item_id"].dataType)])
    return F.broadcast(spark.createDataFrame(list(enumerate(bench.item_ids)), schema))


@dataclass
class _Search:
    bench: Benchmark
    axes: np.ndarray
    idf: np.ndarray
    queries: np.ndarray
    cosine: float

    @cached_property
    def term_sets(self) -> list[frozenset]:
        return [frozenset(item.tolist()) for item in self.bench.items]

    def candidates(self, sequences: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """(sequence, first passage, query, cosine) of all windows near a query."""
        passage, term, count, first = _cells(sequences, len(self.axes))
        if not len(passage):
            return
        weight = ((1 + np.log(count)) * self.idf[term]).astype(np.float32)
        many = int(first[-1]) + -(-len(sequences[-1]) // PASSAGE)
        latent = np.zeros((many + 1, self.axes.shape[1]), np.float32)
        for rows, used, dense in _dense_parts(passage, term, weight):
            latent[rows] = dense @ self.axes[used]
        owner = np.repeat(np.arange(len(sequences)), np.diff(np.append(first, many)))
        inside = np.append(owner[1:] == owner[:-1], False)
        window = latent[:-1] + latent[1:] * inside[:, None]
        norms = np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-9)
        window /= norms
        for low in range(0, many, 4096):
            for q in range(0, len(self.queries), 1024):
                near = window[low : low + 4096] @ self.queries[q : q + 1024].T
                w, i = np.nonzero(near >= self.cosine)
                row = owner[low + w]
                yield from zip(row.tolist(), (low + w - first[row]).tolist(), (q + i).tolist(), near[w, i].tolist())

    def matches(self, sequences: list[np.ndarray]) -> Iterator[tuple[int, tuple]]:
        best: dict[tuple[int, int], tuple] = {}
        for row, passage, part, near in self.candidates(sequences):
            number = self.bench.part_item[part]
            item, answer = self.bench.items[number], self.bench.answers[number]
            # The item may start up to its own length before the window and end as far behind.
            start = max(0, passage * PASSAGE - len(item))
            around = sequences[row][start : (passage + 2) * PASSAGE + len(item)]
            around = around[around >= 0]
            # An item's term that is not there lacks at least one word of the subsequence: often that settles it.
            absent = self.term_sets[number].difference(around.tolist())
            if (len(item) - len(absent)) / len(item) < POSSIBLE:
                continue
            common = common_words(item, around) / len(item)
            if common < POSSIBLE:
                continue
            told = common_words(answer, around) / max(1, len(answer))
            if common >= SURE or told >= ANSWER:
                match = (number, start, near, common, told)
                if (row, number) not in best or match[3] > best[row, number][3]:
                    best[row, number] = match
        for (row, _), match in sorted(best.items()):
            yield row, match


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs``, without documents that contain a benchmark item. Null doc_ids stay."""
    found = find_leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")


def drop_leaking_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs``, without the rows that contain a benchmark item, whatever their doc_id."""
    keyed, key = with_row_key(docs, "rows")
    found = find_leaks(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    return keyed.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").drop(key)
