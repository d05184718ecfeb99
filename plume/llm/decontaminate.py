"""Benchmark decontamination: SimHash fingerprints of item-sized document
windows, found by a multi-index over Hamming blocks, verified by the exact
similarity of weighted shingles.

A fingerprint is 64 bits over the five-word shingles of a text, weighted by
how often they occur. Item fingerprints are cut into ``RADIUS + 1`` blocks;
of two fingerprints within the radius, one block at least is equal, so
probing all blocks finds every item fingerprint within the radius. A window
and an item match if the sum of smaller weights is at least
:data:`SIMILARITY` of the sum of larger ones.

A window that shares no shingle with any item has similarity 0 with all, so
only windows that do are fingerprinted: for each shared shingle, the window
of the item's size that lies where the item would. The index gives the pairs
to verify. Fingerprints farther apart than the radius do not rule a pair out:
of the pairs that the index leaves, those are verified too in which as many of
a window's shingles are the item's as the similarity needs; a result row says
which kind it is (``within_radius``). If no such window of a text matches an
item, the windows that begin at a shared shingle are tried, and those from the
text's start that end at one: cut elsewhere, a window shares no more. So no
pair is missed.

Items are sent to the executors :data:`ITEMS` at a time, and the documents
are read once for each lot; there is no other bound on the benchmark.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of non-ASCII
characters, so case and punctuation don't count. Defined results: a text of
one to four words is one shingle, its whole sequence, and only matches a text
of the same words; null and empty texts match nothing; each (document, item)
pair is given once, with its best window, the first of equals; repeated
documents are judged alike; rows with the same id each give their own pairs;
windows at a text's ends are cut off there. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import map_batches, map_whole, text_columns

SHINGLE = 5
SIMILARITY = 0.8
#: Of a pair at similarity 0.8, about 10 of 64 bits differ, with a deviation of 3.
RADIUS = 16
#: Items a broadcast holds, at most, and bytes of their texts.
ITEMS, ITEM_BYTES = 20_000, 16 << 20
_FILTER_BITS = 20

SCHEMA = "doc_id long, item_id long, similarity double, start_word long, n_words long, within_radius boolean"


def fingerprints(value: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of each run value[start:start + size]; sizes are at least 1."""
    out = np.zeros(len(starts), tb.U64)
    weights = np.uint64(1) << np.arange(64, dtype=tb.U64)
    step = max(1, int(100_000 / max(1, sizes.mean()))) if len(sizes) else 1
    for lo in range(0, len(starts), step):
        own, n = starts[lo:lo + step], sizes[lo:lo + step]
        at = np.cumsum(n) - n
        rows = value[np.repeat(own - at, n) + np.arange(int(n.sum()))]
        bits = np.unpackbits(rows.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
        out[lo:lo + step] = ((2 * ones > n[:, None]) * weights).sum(axis=1, dtype=tb.U64)
    return out


@dataclass(frozen=True)
class Index:
    item_id: list
    n_words: np.ndarray
    counters: list[Counter]
    prints: np.ndarray
    hashes: np.ndarray  # sorted shingles of all items, with item and offset
    item: np.ndarray
    offset: np.ndarray
    seen: np.ndarray  # by the top bits of a shingle: whether any item may have it
    blocks: list[tuple[int, int, np.ndarray, np.ndarray]]  # shift, mask, sorted block values, items

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, through the blocks."""
        pairs = []
        for shift, mask, values, items in self.blocks:
            own = (prints >> tb.U64(shift)) & tb.U64(mask)
            lo, hi = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            n = hi - lo
            window = np.repeat(np.arange(len(prints)), n)
            item = items[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
            pairs.append(window[close] * len(self.prints) + item[close])
        found = np.unique(np.concatenate(pairs))
        return found // len(self.prints), found % len(self.prints)


def build_index(items: pa.Table) -> Index:
    texts = tb.as_texts(items.column("text"))
    w = tb.words(texts, tb.ALNUM, fold=True)
    value, text = tb.shingles(w, SHINGLE)
    order = np.argsort(text, kind="stable")
    value, text = value[order], text[order]
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    filled = np.flatnonzero(np.diff(first))
    prints = np.zeros(len(texts), tb.U64)
    prints[filled] = fingerprints(value, first[filled], np.diff(first)[filled])
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[(value >> tb.U64(64 - _FILTER_BITS)).astype(np.int64)] = True
    order = np.argsort(value, kind="stable")
    edges = np.linspace(0, 64, RADIUS + 2).astype(int)
    blocks = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        mask = (1 << int(hi - lo)) - 1
        own = (prints[filled] >> tb.U64(lo)) & tb.U64(mask)
        by = np.argsort(own, kind="stable")
        blocks.append((int(lo), mask, own[by], filled[by]))
    return Index(items.column("item_id").to_pylist(), w.per_text,
                 [Counter(value[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)], prints,
                 value[order], text[order], (np.arange(len(value)) - first[text])[order], seen, blocks)


def matches(part: pa.RecordBatch, index: Index) -> list[tuple[int, int, float, int, int, bool]]:
    """(text, item, similarity, first word, words, found by the index) of the best window of each pair, in order."""
    texts = tb.as_texts(part.column("text"))
    w = tb.words(texts, tb.ALNUM, fold=True)
    value, at = tb.windows(w, SHINGLE)
    n_windows = len(value)
    count = w.per_text
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        whole, _ = tb.shingles(tb.Words(w.start, w.end, w.hash, w.first), SHINGLE)
        value, at = np.concatenate([value, whole[n_windows:]]), np.concatenate([at, w.first[short]])
    hit = np.flatnonzero(index.seen[(value >> tb.U64(64 - _FILTER_BITS)).astype(np.int64)])
    lo, hi = (np.searchsorted(index.hashes, value[hit], side) for side in ("left", "right"))
    n = hi - lo
    if not n.sum():
        return []
    posting = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    place = np.repeat(at[hit], n)
    text = np.searchsorted(w.first, place, "right") - 1
    begin = place - index.offset[posting]
    end = np.minimum(begin + index.n_words[index.item[posting]], w.first[text + 1])
    begin = np.maximum(begin, w.first[text])
    best: dict[tuple[int, int], tuple[float, int, int, bool]] = {}

    def runs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, number of shingles and the first one's place of each window."""
        text = np.searchsorted(w.first, begin, "right") - 1
        # A window's shingles are one run: those of a long text in order, that of a short text behind all others.
        is_short = count[text] < SHINGLE
        return text, np.where(is_short, 1, end - begin - SHINGLE + 1), np.where(
            is_short, n_windows + np.searchsorted(short, text), np.searchsorted(at[:n_windows], begin))

    def verify(pairs: np.ndarray, indexed: bool) -> None:
        """Pairs (begin, end, item), in order."""
        text, size, start = runs(pairs[:, 0], pairs[:, 1])
        counter, last = None, None
        for k, (begin, end, i) in enumerate(pairs.tolist()):
            if (begin, end) != last:
                counter, last = Counter(value[start[k]:start[k] + size[k]].tolist()), (begin, end)
            other = index.counters[i]
            shared = sum(min(x, other[h]) for h, x in counter.items() if h in other)
            total = counter.total() + other.total() - shared
            # In whole numbers, so that a pair at the threshold itself counts.
            if 100 * shared >= round(100 * SIMILARITY) * total:
                key = (int(text[k]), i)
                rank = (shared / total, -begin)
                if key not in best or rank > best[key][:2]:
                    best[key] = (*rank, end - begin, indexed)

    windows = np.unique(np.stack([begin, end], 1), axis=0)
    _, size, start = runs(windows[:, 0], windows[:, 1])
    good = size > 0
    windows, size, start = windows[good], size[good], start[good]
    own, near = index.near(fingerprints(value, start, size))

    # Places where a window's shingle is the item's: no fewer than what they share.
    owner = index.item[posting]
    span = len(w.hash) + 1
    places = np.unique(owner * span + place)
    item_size = np.maximum(index.n_words - SHINGLE + 1, 1)

    def enough(begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Pairs (begin, end, item) that may be similar enough, each once and in order."""
        _, size, _ = runs(begin, end)
        most = np.searchsorted(places, item * span + begin + size) - np.searchsorted(places, item * span + begin)
        most = np.minimum(most, item_size[item])
        may = (size > 0) & (100 * most >= round(100 * SIMILARITY) * (size + item_size[item] - most))
        return np.unique(np.stack([begin[may], end[may], item[may]], 1), axis=0)

    found = np.unique(np.column_stack([windows[own], near]), axis=0)
    verify(found, True)
    verify(without(enough(begin, end, owner), found), False)
    owner, place = places // span, places % span
    text = np.searchsorted(w.first, place, "right") - 1
    head, tail, words = w.first[text], w.first[text + 1], index.n_words[owner]
    cut = np.flatnonzero((place + SHINGLE - head <= words) & (count[text] >= SHINGLE))
    other = enough(np.concatenate([place, head[cut]]), np.concatenate([np.minimum(place + words, tail), place[cut] + SHINGLE]),
                   np.concatenate([owner, owner[cut]]))
    text = np.searchsorted(w.first, other[:, 0], "right") - 1
    open_ = [(t, i) not in best for t, i in zip(text.tolist(), other[:, 2].tolist(), strict=True)]
    verify(other[np.array(open_, bool)], False)
    return [(t, i, s, -b - int(w.first[t]), n, near) for (t, i), (s, b, n, near) in sorted(best.items())]


def without(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The rows that are not among the others; both hold each row once, in order."""
    every, first, times = np.unique(np.concatenate([others, rows]), axis=0, return_index=True, return_counts=True)
    return every[(first >= len(others)) & (times == 1)]


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of at most ITEMS items and about ITEM_BYTES of text each, lot by lot."""
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("text IS NOT NULL")
    size = known.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    lots = max(1, -(-size[0] // ITEMS), -(-(size[1] or 0) // ITEM_BYTES))
    lot = F.pmod(F.xxhash64("item_id", "text"), F.lit(lots))
    for k in range(lots):
        part = known.where(lot == k).orderBy("item_id", "text").toArrow()
        if part.num_rows:
            index = build_index(part)
            if len(index.hashes):
                yield index


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that match."""
    out = None
    own = text_columns(docs, "doc_id", "text")
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def judge(part: pa.RecordBatch, shared=shared) -> dict:
            ids, items = part.column("doc_id").to_pylist(), shared.value.item_id
            rows = [(ids[t], items[i], *rest) for t, i, *rest in matches(part, shared.value)]
            return dict(zip(("doc_id", "item_id", "similarity", "start_word", "n_words", "within_radius"),
                            map(list, zip(*rows, strict=True)) if rows else ([],) * 6, strict=True))

        found = map_batches(own, judge, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that match no item, with all their columns; no shuffle."""
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in tb.slices(batches):
                clean = np.ones(part.num_rows, bool)
                clean[[m[0] for m in matches(part, shared.value)]] = False
                yield part.filter(pa.array(clean))

        docs = map_whole(docs, run)
    return docs
