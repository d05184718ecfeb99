"""Periodic run detection on a grammar of the words (operator 13).

A run is a stretch of consecutive words with smallest period q whose length is
at least ``max(12, 2 * q)`` and that no neighbouring word extends. The words of
a slice of texts are put into a Re-Pair grammar; runs are looked for at the
boundary of each nonterminal once, moved to every place the nonterminal stands
for, and merged.

* **What can lie in a run.** Words q apart are equal over at least six places,
  so every word of a run lies in a window of six words that its text holds
  twice. Other words are cut out first; this is exact, and most texts have no
  such window.
* **Re-Pair in rounds.** A round counts all pairs of neighbouring symbols and
  replaces every occurrence of a repeated pair that is more frequent (by power
  of two, ties by hash) than the pairs it overlaps. It ends when a round
  shortens the sequence by less than one in a hundred; what is left of a
  stretch is joined to a balanced tree, whose nodes stand in one place each.
* **Boundary runs.** A run that crosses the boundary b with period q has equal
  words at (b - 1, b - 1 + q) or at (b - q, b). Such places come from an index
  of the words, and are extended to both sides by exact ranks of all windows
  of 2**k words.
* **Merging.** The lowest node that holds a run whole finds it whole; lower
  ones find parts of it with the same period, which lie inside it.

Words are told apart by 64-bit hashes. Null and empty texts have no words and
no runs. Every text is taken whole, in one task; memory follows the slice of
texts or the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from plume.llm import textbatch as T
from plume.llm.common import as_array, unused

MIN_LENGTH = 12
#: Equal words q apart span at least max(MIN_LENGTH - q, q) places, which is six or more.
WINDOW = MIN_LENGTH // 2
#: Boundary places extended at a time.
CHUNK = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``runs``, (start, length, period) by start and period, words counted from 0, and ``collapsed``:
    the words, joined by one blank, without those that a run holds after its first period."""
    runs, collapsed = unused(docs, "runs", "collapsed")
    names = [f"column{i}" for i in range(len(docs.columns))]  # whatever the table's own columns are called
    inside = docs.select("*", F.col(f"`{text}`").alias(unused(docs, "words_from")[0])).toDF(*names, "words_from")
    made = StructType.fromDDL(f"runs {RUNS}, collapsed string")
    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)] + made.fields)
    target = to_arrow_schema(schema)

    def run(batches):
        for part in T.slices(batches, "words_from"):
            texts = T.as_texts(part.column("words_from"))
            words = T.words(texts)
            where, start, length, period = runs_of(words)
            kept = kept_words(words, where, start, length, period)
            per_text = T.sum_by_text(kept.astype(np.int64), words.first)
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(where, np.arange(len(texts) + 1)), pa.int32()),
                                             pa.StructArray.from_arrays([start, length, period], ["start", "length", "period"]))
            columns = [*[part.column(n) for n in names], found, join_words(texts, words, np.flatnonzero(kept), per_text)]
            yield pa.RecordBatch.from_arrays([as_array(c, f.type) for c, f in zip(columns, target)], schema=target)

    return inside.mapInArrow(run, schema).toDF(*docs.columns, runs, collapsed)


def repeat_tails(docs: DataFrame) -> DataFrame:
    """The test damage of the query: with h = crc32 of the decimal doc_id and g = h div 10, a text of n words with
    h % 10 = 0 repeats, from word a = g % n on, its next 1 + (n - a) div (3 + g % 8) words. A null doc_id leaves the
    text as it is."""
    marked = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))

    def run(batches):
        for part in T.slices(batches):
            h = part.column("h").fill_null(1).to_numpy(zero_copy_only=False)
            picked = np.flatnonzero(h % 10 == 0)
            column = part.column("text")
            if len(picked):
                some = column.take(pa.array(picked))
                texts = T.as_texts(some)
                words = T.words(texts)
                n, g = words.per_text, h[picked] // 10
                a = g % np.maximum(n, 1)
                p = 1 + (n - a) // (3 + g % 8)
                of = words.text_of()
                i = np.arange(len(of)) - words.first[of]
                take = words.first[of] + np.where(i >= a[of], a[of] + (i - a[of]) % p[of], i)
                changed = join_words(texts, words, take, n)
                mask = np.zeros(part.num_rows, bool)
                mask[picked] = True
                column = pc.replace_with_mask(column, pa.array(mask), changed.cast(column.type))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], names=["doc_id", "text"])

    return marked.mapInArrow(run, "doc_id long, text string")


def join_words(texts: T.Texts, words: T.Words, take: np.ndarray, per_text: np.ndarray) -> pa.Array:
    """Texts of the words at ``take``, ``per_text`` of them each, joined by one blank."""
    size = words.end[take] - words.start[take] + 1
    out = np.full(int(size.sum()), 0x20, np.uint8)
    to = np.cumsum(size)
    for at in range(0, len(take), CHUNK):
        part = slice(at, at + CHUNK)
        n = size[part] - 1
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[part] - size[part], n) + within] = texts.data[np.repeat(words.start[take[part]], n) + within]
    last = np.cumsum(per_text)
    worded = per_text > 0
    ends = np.concatenate([[0], to])[last]
    out = np.delete(out, ends[worded] - 1)  # no blank after a text's last word
    offsets = np.concatenate([[0], ends - np.cumsum(worded)])
    return pa.LargeStringArray.from_buffers(len(per_text), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def kept_words(words: T.Words, where: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each word stays: it lies in no run behind that run's first period."""
    n = len(words.hash)
    begin = words.first[where] + start
    cover = np.bincount(begin + period, minlength=n + 1) - np.bincount(begin + length, minlength=n + 1)
    return np.cumsum(cover[:n]) == 0


def runs_of(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period."""
    place, stretch = repeated_places(words)
    none = np.zeros(0, np.int64)
    if not len(place):
        return none, none, none, none
    _, symbols = np.unique(words.hash[place], return_inverse=True)
    symbols = symbols.astype(np.int64)
    grammar = repair(symbols, stretch)
    start, length, period = merged(*translated(grammar, *boundary_runs(grammar, symbols)))
    begin = place[start]
    text = np.searchsorted(words.first, begin, "right") - 1
    order = np.lexsort((period, begin))
    return text[order], (begin - words.first[text])[order], length[order], period[order]


def repeated_places(words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Words that may lie in a run, and the stretch that each belongs to: at least MIN_LENGTH neighbouring words of a
    text, all in windows of WINDOW words that the text holds twice."""
    value, at = T.windows(words, WINDOW)
    n = len(words.hash)
    text = np.searchsorted(words.first, at, "right") - 1
    times, _ = T.counts(value, text, len(words.first) - 1)
    at = at[times > 1]
    covered = np.cumsum(np.bincount(at, minlength=n + 1) - np.bincount(at + WINDOW, minlength=n + 1)[:n + 1])[:n] > 0
    place = np.flatnonzero(covered)
    if not len(place):
        return place, place
    head = np.ones(len(place), bool)
    head[1:] = np.diff(place) > 1
    begins = words.first[:-1]
    begins = np.searchsorted(place, begins[begins < n])
    head[begins[begins < len(place)]] = True
    stretch = np.cumsum(head) - 1
    long = np.bincount(stretch)[stretch] >= MIN_LENGTH
    return place[long], stretch[long]


class Grammar:
    """Nonterminals in the order they were made: where one stands first, the length of its left and of both parts; and
    all places, by nonterminal."""

    def __init__(self) -> None:
        self._made: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, node: np.ndarray, place: np.ndarray, left: np.ndarray, both: np.ndarray) -> None:
        """Occurrences of new nonterminals, numbered from ``n`` on."""
        order = np.argsort(node, kind="stable")
        self._made.append((node[order] + self.n, place[order], left[order], both[order]))
        self.n += int(node.max()) + 1

    def finish(self) -> "Grammar":
        node, self.place, left, both = (np.concatenate(c) for c in zip(*self._made))
        self.first = np.searchsorted(node, np.arange(self.n + 1))
        self.left, self.both, self.start = left[self.first[:-1]], both[self.first[:-1]], self.place[self.first[:-1]]
        return self


def repair(symbols: np.ndarray, stretch: np.ndarray) -> Grammar:
    """The grammar of the sequence; pairs never reach from one stretch into the next."""
    grammar = Grammar()
    symbol, group, place = symbols, stretch, np.arange(len(symbols))
    size = np.ones(len(symbols), np.int64)
    fresh = int(symbols.max()) + 1

    def join(at: np.ndarray, node: np.ndarray) -> None:
        nonlocal symbol, group, place, size, fresh
        grammar.add(node, place[at], size[at], size[at] + size[at + 1])
        symbol, size = symbol.copy(), size.copy()
        symbol[at] = node + fresh
        size[at] += size[at + 1]
        fresh += int(node.max()) + 1
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        symbol, group, place, size = symbol[stay], group[stay], place[stay], size[stay]

    while True:
        at, pair = frequent_pairs(symbol, group)
        before = len(symbol)
        if len(at):
            join(at, pair)
        if (before - len(symbol)) * 100 < before:
            break
    while True:
        head = np.searchsorted(group, group)  # the first symbol of the own stretch
        within = np.arange(len(symbol)) - head
        at = np.flatnonzero((within[:-1] % 2 == 0) & (group[:-1] == group[1:]))
        if not len(at):
            return grammar.finish()
        join(at, np.arange(len(at)))


def frequent_pairs(symbol: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs are replaced in this round, no two overlapping, and the number of each one's pair."""
    n = len(symbol)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index = np.arange(n)
    change = np.ones(n, bool)
    change[1:] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
    within = index - np.maximum.accumulate(np.where(change, index, 0))
    # Of a symbol's repetitions (aaaa) only every other pair counts, as they overlap.
    usable = np.flatnonzero((group[:-1] == group[1:]) & ((symbol[:-1] != symbol[1:]) | (within[:-1] % 2 == 0)))
    if not len(usable):
        return usable, usable
    _, pair, count = np.unique(symbol[usable] * (int(symbol.max()) + 1) + symbol[usable + 1], return_inverse=True, return_counts=True)
    rank = (np.floor(np.log2(count)).astype(np.uint64) << T.U64(58)) | (T.mix(np.arange(len(count), dtype=np.uint64) + T.U64(n)) >> T.U64(6))
    rank[count < 2] = 0
    weight = np.zeros(n + 1, np.uint64)  # of the pair that starts at each symbol; shifted by one
    weight[usable + 1] = rank[pair]
    own = weight[1:]
    after = np.append(own[1:], T.U64(0))
    best = (own > weight[:-1]) & (own >= after) & (own > 0)
    chosen = best[usable]
    at, pair = usable[chosen], pair[chosen]
    often = np.bincount(pair, minlength=len(count))
    at, pair = at[often[pair] > 1], pair[often[pair] > 1]
    return at, np.unique(pair, return_inverse=True)[1].astype(np.int64)


class Ranks:
    """Exact numbers of all windows of 2**k symbols: equal numbers mean equal windows."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        self.levels = [symbols]
        while 2 << (len(self.levels) - 1) <= longest:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            code = last[:-step] * (int(last.max()) + 1) + last[step:]
            self.levels.append(np.unique(code, return_inverse=True)[1].astype(np.int64))

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from a on equal those from b on, ``limit`` at most; or before a and b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step, level = 1 << k, self.levels[k]
            if limit.max(initial=0) < step:
                continue
            fits = np.flatnonzero(out + step <= limit)
            shift = -(out[fits] + step) if back else out[fits]
            same = level[a[fits] + shift] == level[b[fits] + shift]
            out[fits[same]] += step
        return out


def boundary_runs(grammar: Grammar, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """(nonterminal, start inside it, length, period) of the runs, within each nonterminal, across its boundary."""
    node = np.flatnonzero(grammar.both >= MIN_LENGTH)
    low = grammar.start[node]
    high, mid = low + grammar.both[node], low + grammar.left[node]
    ranks = Ranks(symbols, int(grammar.both.max()))
    n = len(symbols) + 1
    order = np.argsort(symbols, kind="stable")
    key = symbols[order] * n + order
    # Places behind the boundary that equal the word before it, and places before it that equal the word behind it.
    right = np.searchsorted(key, [symbols[mid - 1] * n + mid, symbols[mid - 1] * n + high])
    left = np.searchsorted(key, [symbols[mid] * n + low, symbols[mid] * n + mid])
    many = np.cumsum((right[1] - right[0]) + (left[1] - left[0]))
    found = []
    at = 0
    while at < len(node):
        to = max(at + 1, int(np.searchsorted(many, (many[at - 1] if at else 0) + CHUNK, "right")))
        part = np.arange(at, to)
        which = np.concatenate([np.repeat(part, right[1, part] - right[0, part]), np.repeat(part, left[1, part] - left[0, part])])
        place = order[np.concatenate([ranges(right[0, part], right[1, part]), ranges(left[0, part], left[1, part])])]
        behind = place >= mid[which]
        anchor = np.where(behind, mid[which] - 1, place)
        period = np.where(behind, place, mid[which]) - anchor
        on = ranks.common(anchor, anchor + period, high[which] - anchor - period)
        back = ranks.common(anchor, anchor + period, anchor - low[which], back=True)
        length = on + back + period
        good = length >= np.maximum(MIN_LENGTH, 2 * period)
        which, start, length, period = which[good], (anchor - back)[good], length[good], period[good]
        by = np.lexsort((period, length, start, which))  # of equal stretches the smallest period
        head = np.ones(len(by), bool)
        head[1:] = np.any([c[by][1:] != c[by][:-1] for c in (which, start, length)], axis=0)
        by = by[head]
        found.append((node[which[by]], start[by] - low[which[by]], length[by], period[by]))
        at = to
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of all ranges, one range after another."""
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def translated(grammar: Grammar, node: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray):
    """(start, length, period) at every place of each run's nonterminal."""
    low, high = grammar.first[node], grammar.first[node + 1]
    times = high - low
    return grammar.place[ranges(low, high)] + np.repeat(start, times), np.repeat(length, times), np.repeat(period, times)


def merged(start: np.ndarray, length: np.ndarray, period: np.ndarray):
    """The intervals that lie in no other one of the same period."""
    order = np.lexsort((-length, start, period))
    start, length, period = start[order], length[order], period[order]
    if not len(start):
        return start, length, period
    end = start + length
    reach = end + period * (int(end.max()) + 1)  # periods come one after another
    before = np.concatenate([[-1], np.maximum.accumulate(reach)[:-1]])
    return start[reach > before], length[reach > before], period[reach > before]
