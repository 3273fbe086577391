"""Tokenizing by white-space chunks, each distinct chunk once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A task has one core; threads of the library would each keep memory of their own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space as the tokenizers' patterns see it (the Unicode property).
SPACE = "\t-\r \x85\xa0  -     　"
#: White space for Python, but not for the tokenizers.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Marks that often follow a word.
ENDING = frozenset(".,!?;:")
#: Bytes of text whose distinct words are encoded at once, and words whose ids are put together at once.
SLICE, GATHERED = 16_000_000, 400_000
#: Chunks kept per Python worker; the store is emptied when it is full.
MAX_CHUNKS = 400_000

_split_words = re.compile(f"[{SPACE}]+").split
_find_pieces = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall


def words_of(text: str) -> list[str]:
    """Maximal runs without white space, for tokenizers that drop white space."""
    if not any(c in text for c in SEPARATORS):
        return text.split()
    return [w for w in _split_words(text) if w]


def pieces_of(text: str) -> list[str]:
    """Cuts before each single space and word, where byte-level pre-tokenizers always cut."""
    return _find_pieces(text)


@lru_cache
def _tokenizer(path: str, plain_specials: bool):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


def _plain_letters(word: str) -> bool:
    """Whether normalizing and lower-casing leave one run of letters."""
    return word.isalpha() and (word.isascii() or normalize("NFC", word).lower().isalpha())


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(starts - ends + sizes, sizes)]


class WordEncoder:
    """Texts to little-endian uint16 ids with a tokenizer that drops white space and marks word ends.

    Equal to encoding each whole text: white space separates words for such a tokenizer, and
    it closes every word with a token whose name ends in ``</w>``. So the distinct words of a slice are
    encoded as one text, and the ids are cut at the closing tokens. A word of letters
    with one punctuation mark behind it is put together from both. Nothing is kept from slice to slice.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        self.tokenizer = _tokenizer(path, plain_specials)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(names.values()) + 1, bool)
        self.closing[[i for t, i in names.items() if t.endswith("</w>")]] = True

    def _learn(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, sizes): the ids of every word as a stretch of one array."""
        pools, at = [np.zeros(0, "<u2")], 0
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        simple = pc.ascii_is_alpha(words).to_numpy(zero_copy_only=False)
        words = words.to_pylist()
        plain_at, other = np.flatnonzero(simple).tolist(), []
        for i in np.flatnonzero(~simple).tolist():
            (plain_at if _plain_letters(words[i]) else other).append(i)
        for first in range(0, len(plain_at), 2000):
            part = plain_at[first : first + 2000]
            text = " ".join([words[i] for i in part])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) != len(part):  # a letter that the tokenizer's tables do not know
                other.extend(part)
                continue
            cuts = np.concatenate(([0], ends))
            starts[part], sizes[part] = cuts[:-1] + at, np.diff(cuts)
            pools.append(ids)
            at += len(ids)
        for i, found in zip(other, self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)):
            starts[i], sizes[i] = at, len(found.ids)
            pools.append(np.array(found.ids, "<u2"))
            at += len(found.ids)
        return np.concatenate(pools), starts, sizes

    def _distinct(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_learn``, with every stem learnt once."""
        last, stem = pc.utf8_slice_codeunits(words, -1), pc.utf8_slice_codeunits(words, 0, -1)
        ending = pc.is_in(last, pa.array(sorted(ENDING)))
        cut = pc.and_(ending, pc.ascii_is_alpha(stem)).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(pc.and_not(ending, pc.string_is_ascii(stem)).to_numpy(zero_copy_only=False)).tolist():
            cut[i] = _plain_letters(stem[i].as_py())
        left, right = pc.if_else(pa.array(cut), stem, words), pc.if_else(pa.array(cut), last, "")
        left = pc.if_else(pc.ascii_is_alpha(left), pc.ascii_lower(left), left)
        parts = pa.concat_arrays([left, right]).dictionary_encode()
        pool, starts, sizes = self._learn(parts.dictionary)
        both = parts.indices.to_numpy(zero_copy_only=False).reshape(2, -1).T.ravel()
        pool, sizes = _gather(pool, starts[both], sizes[both]), sizes[both].reshape(-1, 2).sum(axis=1)
        return pool, np.cumsum(sizes) - sizes, sizes

    def encode_arrays(self, texts: pa.Array, end_id: int | None = None) -> Iterator[pa.BinaryArray]:
        """The ids of every text as bytes, in a few arrays; ``end_id`` closes every text. Null is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lists = pc.utf8_split_whitespace(texts)
        if pc.any(pc.match_substring_regex(texts, f"[{SEPARATORS}]")).as_py():
            lists = pa.array([words_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        cut = lists.flatten().dictionary_encode()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        pool, starts, sizes = self._distinct(cut.dictionary)
        codes = cut.indices.to_numpy(zero_copy_only=False)
        if end_id is not None:
            codes = np.insert(codes, ends, len(starts))
            pool, starts, sizes = np.append(pool, np.uint16(end_id)), np.append(starts, len(pool)), np.append(sizes, 1)
            ends = ends + np.arange(1, len(ends) + 1)
        first = word = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, word + GATHERED, "right")))
            part = codes[word : ends[last - 1]]
            long = sizes[part]
            cuts = np.concatenate(([0], np.cumsum(long)))[ends[first:last] - word]
            offsets = pa.py_buffer(np.concatenate(([0], 2 * cuts)).astype(np.int32))
            ids = pa.py_buffer(_gather(pool, starts[part], long).astype("<u2"))
            yield pa.BinaryArray.from_buffers(pa.binary(), last - first, [None, offsets, ids])
            first, word = last, int(ends[last - 1])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [x for found in self.encode_arrays(pa.array(texts, pa.string())) for x in found.to_pylist()]


@lru_cache
def word_encoder(path: str, plain_specials: bool = False) -> WordEncoder:
    """One encoder per Python worker and tokenizer file."""
    return WordEncoder(path, plain_specials)


def batched(texts: list[str], most: int = 2_000_000):
    """Slices of ``texts`` of about ``most`` characters, so that long texts come alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    yield slice(start, len(texts))


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of a text or binary column, so that long texts come alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield batch.slice(start)
