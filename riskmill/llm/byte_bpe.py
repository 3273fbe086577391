"""Byte-pair encoding and decoding in numpy, many words at a time.

The merge rules become one sorted array of pair keys. The symbols of all distinct
words of a batch lie in one flat array; a round finds the rank of every neighbouring
pair by binary search, the lowest rank of every word by a segmented minimum, and merges
that pair everywhere in its word, from the left. Words without a mergeable pair leave
the array, so the rounds end with the longest word.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskmill.llm.chunks import MAX_CHUNKS, SPACE, batched, pieces_of
from riskmill.llm.common import plain

#: Fixed value: the pre-tokenizer pattern of byte-level tokenizers, white space spelled out.
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
NONE = np.int64(1 << 60)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others take the letters from
    code point 256 on, in order.
    """
    printable = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class ByteBpe:
    """A byte-level BPE tokenizer file, equal to the tokenizers library without special handling.

    ``encode`` and ``decode`` work on lists of whole texts. Special strings of the
    file are found in texts, as the library does by default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, letters = spec["model"]["vocab"], byte_letters()
        self.byte_id = np.array([vocabulary[c] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        back = {c: b for b, c in enumerate(letters)}
        specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = {**{i: t for t, i in vocabulary.items()}, **{i: t for t, i in specials.items()}}
        raw = [self._raw(names.get(i, ""), back) for i in range(max(names) + 1)]
        self.piece_size = np.array([len(x) for x in raw], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.pieces = np.frombuffer(b"".join(raw), np.uint8)
        self.specials = specials
        self.decimal = [b",%d" % i for i in range(len(raw))]
        self.find_words = regex.compile(PATTERN).findall
        ordered = sorted(specials, key=len, reverse=True)
        self.cut_specials = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")").split if ordered else None
        self.known: dict[str, tuple[bytes, bytes]] = {}

    @staticmethod
    def _raw(token: str, back: dict[str, int]) -> bytes:
        return bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (at least one byte each), each merged on its own, and where each word's end."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = (self.keys[at] == key) & (word[1:] == word[:-1]) if len(self.keys) else np.zeros(len(key), bool)
            rank = np.append(np.where(found, self.rank[at] if len(self.keys) else 0, NONE), NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.append(starts, len(word)))
            best = np.repeat(lowest, spans)
            finished = best == NONE
            if finished.any():
                done_symbols.append(symbols[finished])
                done_words.append(word[finished])
            hit = (rank == best) & ~finished
            # Of a run of overlapping pairs (a letter repeated), every second one merges.
            places = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit, -1, places))
            hit &= (places - run) % 2 == 1
            symbols = np.where(hit, self.made[np.where(hit, rank, 0)], symbols)
            keep = ~finished
            keep[1:] &= ~hit[:-1]
            symbols, word = symbols[keep], word[keep]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.cumsum(np.bincount(word, minlength=len(words)))

    def _learn(self, chunks: list[str]) -> None:
        cut = [self.find_words(c) for c in chunks]
        words = list(set().union(*cut))
        made: dict[str, tuple[bytes, bytes]] = {}
        for part in batched(words, 2_000_000):
            some = words[part]
            flat, ends = self.merge_words([w.encode() for w in some])
            raw, decimal, start = flat.astype("<u4").tobytes(), [self.decimal[i] for i in flat.tolist()], 0
            for word, end in zip(some, ends.tolist()):
                made[word] = raw[4 * start : 4 * end], b"".join(decimal[start:end])
                start = end
        for chunk, found in zip(chunks, cut):
            if len(found) == 1:
                self.known[chunk] = made[found[0]]
            else:
                self.known[chunk] = b"".join([made[w][0] for w in found]), b"".join([made[w][1] for w in found])

    def _chunks(self, text: str) -> list[str]:
        if self.cut_specials is None or not any(s in text for s in self.specials):
            return pieces_of(text)
        found = []
        for i, part in enumerate(self.cut_specials(text)):
            found.extend([part] if i % 2 else pieces_of(part))
        return found

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian uint32, decimal ids joined by commas) of every text."""
        cuts = [self._chunks(t) for t in texts]
        wanted = set().union(*cuts)
        if len(self.known) + len(wanted) > MAX_CHUNKS:
            self.known.clear()
        for name, i in self.specials.items():
            self.known[name] = np.array([i], "<u4").tobytes(), b",%d" % i
        fresh = [c for c in wanted if c not in self.known]
        if fresh:
            self._learn(fresh)
        out = []
        for cut in cuts:
            found = [self.known[c] for c in cut]
            out.append((b"".join(f[0] for f in found), b"".join(f[1] for f in found)[1:]))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of little-endian uint32 ids; special tokens are kept, bad bytes replaced."""
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        size = self.piece_size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) - np.repeat(ends - size, size) + np.repeat(self.piece_start[at], size)
        return self.pieces[place].tobytes().decode("utf-8", "replace")


@lru_cache
def tokenizer(path: str) -> ByteBpe:
    """One tokenizer, with its store of known chunks, per Python worker."""
    return ByteBpe(path)


def _mapped(docs: DataFrame, path: str, rows, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for cut in batched(texts):
                columns = rows(bpe, texts[cut])
                names = batch.column(0).slice(cut.start, len(texts[cut]))
                yield pa.RecordBatch.from_arrays([names, *columns.values()], ["doc_id", *columns])

    return plain(docs, "doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {ddl}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, exact) of every text of ``docs`` (doc_id, text).

    Null and empty texts have no ids. ``exact`` tells that decoding gives the text back.
    Repeated rows and null doc_ids stay as they are.
    """

    def rows(bpe: ByteBpe, texts: list[str]) -> dict[str, pa.Array]:
        found = [ids for ids, _ in bpe.encode(texts)]
        flat = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
        offsets = np.cumsum([0] + [len(x) // 4 for x in found])
        return {
            "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
            "n_tokens": pa.array(np.diff(offsets), pa.int64()),
            "exact": pa.array([bpe.decode(i) == t for i, t in zip(found, texts)]),
        }

    return _mapped(docs, path, rows, "ids array<int>, n_tokens bigint, exact boolean")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids array<int>); a null array is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return plain(encoded, "doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) after encoding and decoding every text."""

    def rows(bpe: ByteBpe, texts: list[str]) -> dict[str, pa.Array]:
        found = bpe.encode(texts)
        return {
            "n_tokens": pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(decimal).hexdigest() for _, decimal in found]),
            "decoded_sha256": pa.array([hashlib.sha256(bpe.decode(ids).encode()).hexdigest() for ids, _ in found]),
        }

    return _mapped(docs, path, rows, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")

