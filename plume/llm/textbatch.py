"""Vectorised word work on Arrow string columns, shared by the operators.

A text column reaches Python as one UTF-8 buffer with offsets; words, lines
and shingles are found by numpy over that buffer, without a Python object per
word. Batches are cut by bytes (:func:`slices`), so memory follows the slice
size or the longest single text, whichever is larger.

Words are compared by 64-bit hashes of their bytes; two different words share
a hash with probability 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
U64 = np.uint64

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=U64)
_STEP = U64(0x9E3779B97F4A7C15)
_SHINGLE = _rng.integers(0, 1 << 63, 16, dtype=U64) * U64(2) + U64(1)
_powers = np.ones(1, U64)


def table(predicate) -> np.ndarray:
    """256 booleans: which bytes satisfy the predicate."""
    return np.fromiter((predicate(b) for b in range(256)), bool, 256)


#: Words ``[^\x20\x09-\x0D]+``.
NOT_BLANK = table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
#: Lines: everything between newlines.
NOT_NEWLINE = table(lambda b: b != 0x0A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[U64(1)], np.full(max(n, 64) * 2, _STEP | U64(1), U64)]))
    return _powers


@dataclass
class Texts:
    """A slice of a text column: bytes and the bounds of each text."""

    data: np.ndarray
    bounds: np.ndarray  # len(texts) + 1 byte offsets into data

    def __len__(self) -> int:
        return len(self.bounds) - 1


def as_texts(column: pa.Array) -> Texts:
    """Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    return Texts(np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice's texts take ``limit`` bytes or are one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = as_texts(batch.column(column)).bounds
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of a slice, text after text. ``first[i]:first[i + 1]`` are those of text i."""

    start: np.ndarray  # byte offsets
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.per_text)


def find(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in the table: (starts, ends, first run of each text, byte mask)."""
    mask = inside[texts.data]
    n = len(mask)
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    ends = mask.copy()
    ends[:-1] &= ~mask[1:]
    cut = texts.bounds[:-1]
    cut = cut[cut < n]
    begins[cut] |= mask[cut]
    before = cut[cut > 0] - 1
    ends[before] |= mask[before]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, texts.bounds), mask


def words(texts: Texts, inside: np.ndarray = NOT_BLANK, fold: bool = False) -> Words:
    """Runs of bytes in the table, hashed; ``fold`` lower-cases A-Z first."""
    start, end, first, mask = find(texts, inside)
    if not len(start):
        return Words(start, end, np.zeros(0, U64), first)
    raw = texts.data[mask]
    if fold:
        raw = LOWER[raw]
    size = end - start
    at = np.cumsum(size) - size
    within = np.arange(len(raw), dtype=np.int64) - np.repeat(at, size)
    value = _BYTE[raw] * power_table(int(size.max()))[within]
    return Words(start, end, mix(np.add.reduceat(value, at) + size.astype(U64)), first)


def hash_word(word: str) -> int:
    """The hash that :func:`words` gives this word."""
    return int(words(as_texts(pa.array([word])), np.ones(256, bool)).hash[0])


def windows(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows within one text, and the word index each starts at."""
    m = len(w.hash) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    value = w.hash[:m] * _SHINGLE[0]
    for k in range(1, n):
        value += w.hash[k:k + m] * _SHINGLE[k]
    inside = np.ones(m, bool)
    for k in range(1, n):  # windows that would run over a text's end
        late = w.first[1:] - k
        inside[late[(late >= 0) & (late < m)]] = False
    at = np.flatnonzero(inside)
    return mix(value[at]), at


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all n-word shingles; a text of 1 to n - 1 words gives its whole sequence."""
    value, at = windows(w, n)
    text = np.searchsorted(w.first, at, "right") - 1
    count = w.per_text
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.array([_short(w.hash[w.first[i]:w.first[i + 1]]) for i in short], U64)
        value, text = np.concatenate([value, extra]), np.concatenate([text, short])
    return value, text


def _short(hashes: np.ndarray) -> np.uint64:
    return mix((hashes * _SHINGLE[:len(hashes)]).sum(dtype=U64, keepdims=True) ^ U64(len(hashes)))[0]


def keyed(value: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes made different for each text of the slice."""
    return mix(value ^ (text.astype(U64) + U64(1)) * _STEP)


def counts(value: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each hash occurs in its text (aligned to the input), and the distinct hashes of each text."""
    if not len(value):
        return np.zeros(0, np.int64), np.zeros(n_texts, np.int64)
    key = keyed(value, text)
    order = np.argsort(key)
    sorted_ = key[order]
    head = np.ones(len(key), bool)
    head[1:] = sorted_[1:] != sorted_[:-1]
    run = np.cumsum(head) - 1
    size = np.bincount(run)
    out = np.empty(len(key), np.int64)
    out[order] = size[run]
    return out, np.bincount(text[order[head]], minlength=n_texts)


def sum_by_text(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs given by bounds (empty runs give 0)."""
    total = np.concatenate([[0], np.cumsum(value)])
    return total[bounds[1:]] - total[bounds[:-1]]
