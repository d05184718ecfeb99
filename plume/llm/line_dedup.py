"""Line dedup by a segment-partition edit join over the whole corpus.

Two lines are near copies if their edit distance is small for the shorter
one: none below 8 code points, 1 below 16, 2 (:data:`THRESHOLD`) from there.
In short lines two edits make other words of words, so these must be equal.
Near copies, and near copies of those, form a class, of which the first line
stays: the one with the smallest (doc_id, text hash, line number).

Every line of 8 code points or more is cut into threshold + 1 segments of even
length, by its own length's threshold; the index holds
each segment under the line's length, the segment's number and its
characters. Of two lines within the threshold, one segment of the shorter
stands unchanged in the longer one, near its place: the longer line probes
the lengths from its own down to the threshold less, and for each segment only
the few starts that the edits on either side allow. Candidates are verified
by a banded bit-parallel edit distance; :mod:`plume.llm.linking` makes the
classes. Equal lines are one node from the start.

Lines are what stands between newlines. Lines without any but ASCII blanks always stay and are
compared with nothing. Defined results: null
texts stay null, empty ones empty; a text's other lines stay in order, joined
by newlines again; rows equal in id and text are one document and treated
alike; null ids come before all others; a carriage return is part of its
line. Lines are told apart by 64-bit hashes. Other columns are kept as they
are, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import discard, map_batches, map_whole, stored, text_columns, unused
from plume.llm.linking import bits_of, link, may_hold, packed

THRESHOLD = 2
#: LENGTHS[t]: code points from which t edits are allowed.
LENGTHS = [0, 8, 16, 1 << 62]
#: Code points of the shortest line that can be longer than the edits allowed; of the lines below LENGTHS[1], equal ones
#: only are copies.
MIN_CHARS = THRESHOLD + 1

_BASE = tb.U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = tb.U64(pow(int(_BASE), -1, 1 << 64))
_tables = [np.ones(1, tb.U64), np.ones(1, tb.U64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_tables[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            _tables[k] = np.cumprod(np.concatenate([[tb.U64(1)], np.full(n + (n >> 1), b, tb.U64)]))
    return _tables


def _lines(texts: tb.Texts) -> tuple[tb.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty lines with hashes, their bounds in code points, and whether they hold more than blanks."""
    lines = tb.words(texts, tb.NOT_NEWLINE)
    heads = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    filled = np.concatenate([[0], np.cumsum(tb.NOT_BLANK[texts.data])])
    return lines, heads[lines.start], heads[lines.end], filled[lines.end] > filled[lines.start]


def edits_allowed(length: int) -> int:
    """The threshold for a pair whose shorter line has so many code points."""
    return sum(length >= least for least in LENGTHS[1:THRESHOLD + 1])


def segments(size: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, length) of each of threshold + 1 even segments; the last ones are longer by one."""
    n = threshold + 1
    short, longer = size // n, size % n
    out, start = [], np.zeros_like(size)
    for i in range(n):
        own = short + (i >= n - longer)
        out.append((start, own))
        start = start + own
    return out


def _postings(part: pa.RecordBatch) -> dict:
    texts = tb.as_texts(part.column("text"))
    lines, begin, end, filled = _lines(texts)
    fresh = np.zeros(len(begin), bool)
    fresh[np.unique(lines.hash, return_index=True)[1]] = True
    pick = np.flatnonzero(fresh & filled & (end - begin >= MIN_CHARS))
    begin, end, node = begin[pick], end[pick], lines.hash[pick].astype(np.int64)
    chars = np.frombuffer(texts.data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    power, inverse = _powers(len(chars) + 1)
    sums = np.concatenate([[tb.U64(0)], np.cumsum(tb.mix(chars.astype(tb.U64)) * power[:len(chars)], dtype=tb.U64)])
    size = end - begin
    keys, nodes, indexed, parities = [], [], [], []
    # Bit c: whether characters of class c are odd in number. An edit changes two bits at most.
    flips = np.concatenate([[tb.U64(0)], np.bitwise_xor.accumulate(tb.U64(1) << (chars.astype(tb.U64) * tb.U64(0x9E3779B97F4A7C15) >> tb.U64(58)))]) \
        if len(chars) else np.zeros(1, tb.U64)
    parity = (flips[end] ^ flips[begin]).astype(np.int64)
    for t in range(1, THRESHOLD + 1):
        for less in range(t + 1):  # how much shorter the indexed line is
            own = np.flatnonzero((size - less >= LENGTHS[t]) & (size - less < LENGTHS[t + 1]))
            indexed_size, first, last, n_own, p_own = size[own] - less, begin[own], end[own], node[own], parity[own]
            for i, (start, length) in enumerate(segments(indexed_size, t)):
                place = tb.mix(indexed_size.astype(tb.U64) * tb.U64(THRESHOLD + 1) + tb.U64(i))
                # Left of the segment at most i edits have happened, right of it at most t - i.
                for move in range(max(-i, less - (t - i)), min(i, less + (t - i)) + 1):
                    a = first + start + move
                    fits = np.flatnonzero((a >= first) & (a + length <= last))
                    a, stop = a[fits], (a + length)[fits]
                    keys.append(tb.mix((sums[stop] - sums[a]) * inverse[a] ^ place[fits]))
                    nodes.append(n_own[fits])
                    parities.append(p_own[fits])
                    indexed.append(np.full(len(fits), less == 0 and move == 0))
    key, nodes, indexed = (np.concatenate(x) for x in (keys, nodes, indexed))
    none = np.zeros(len(key), np.int64)
    return {"key": key.astype(np.int64), "node": nodes, "class": none, "rank": none, "indexed": indexed,
            "parity": np.concatenate(parities)}


def within(a: str, b: str, threshold: int | None = None) -> bool:
    """Whether the edit distance is at most the threshold, by default that of the shorter line.

    After j characters of b, bit t of row e says that e edits make them the
    first j + t - threshold characters of a: a band of 2 * threshold + 1 bits.
    """
    if a == b:
        return True
    if threshold is None:
        threshold = edits_allowed(min(len(a), len(b)))
    if abs(len(a) - len(b)) > threshold:
        return False
    lo = 0
    stop = min(len(a), len(b))
    while lo + 64 <= stop and a[lo:lo + 64] == b[lo:lo + 64]:
        lo += 64
    back = 0
    while back + 64 <= stop - lo and a[len(a) - back - 64:len(a) - back] == b[len(b) - back - 64:len(b) - back]:
        back += 64
    a, b = a[lo:len(a) - back], b[lo:len(b) - back]
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + threshold)
    band = (1 << (2 * threshold + 1)) - 1
    rows = [sum(1 << (threshold + i) for i in range(e + 1)) for e in range(threshold + 1)]
    for j, c in enumerate(b):
        match = (where.get(c, 0) >> j) & band
        old, new = 0, 0
        for e, row in enumerate(rows):
            # Equal characters; one replaced; one more in b; one more in a.
            rows[e] = new = ((row & match) | old | (old >> 1) | (new << 1)) & band
            old = row
        if not new:
            return False
    at = len(a) - len(b) + threshold
    return bool(rows[threshold] >> at & 1)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the text's hash and the text: what tells documents apart."""
    return text_columns(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))


def _line_rows(part: pa.RecordBatch) -> dict:
    texts = tb.as_texts(part.column("text"))
    lines, _, _, filled = _lines(texts)
    own = np.flatnonzero(filled)
    text = lines.text_of()[own]
    newline = np.concatenate([[0], np.cumsum(texts.data == 0x0A)])
    number = newline[lines.start[own]] - newline[texts.bounds[text]]
    rows = pa.array(text)
    return {"doc_id": part.column("doc_id").take(rows), "text_hash": part.column("text_hash").take(rows),
            "line": number, "node": lines.hash[own].astype(np.int64)}


def _verify(docs: DataFrame, firsts: DataFrame):
    """Pairs of nodes to those within the threshold; only the lines that take part are fetched."""
    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            return pairs
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        places = firsts.join(nodes, "node", "left_semi")
        spark = docs.sparkSession
        texts_wanted = spark.sparkContext.broadcast(bits_of(places.select(
            F.xxhash64("p.doc_id", "p.text_hash").alias("key"))))  # 2**FILTER_BITS bits each
        lines_wanted = spark.sparkContext.broadcast(bits_of(nodes.withColumnRenamed("node", "key")))
        texts = _keyed(docs).select(F.xxhash64("doc_id", "text_hash").alias("key"), "text")

        def fetch(part: pa.RecordBatch) -> dict:
            part = part.filter(pa.array(may_hold(part.column("key").to_numpy(), texts_wanted.value)))
            texts = tb.as_texts(part.column("text"))
            found = tb.words(texts, tb.NOT_NEWLINE)
            pick = np.unique(found.hash, return_index=True)[1]
            pick = pick[may_hold(found.hash[pick], lines_wanted.value)]
            raw = texts.data.tobytes()
            return {"node": found.hash[pick].astype(np.int64),
                    "content": [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(found.start[pick], found.end[pick], strict=True)]}

        content = stored(map_batches(texts, fetch, "node long, content string").dropDuplicates(["node"]), "content")

        def compare(batches):
            for part in batches:
                keep = [within(x, y) for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        out = stored(pairs.join(content.select(F.col("node").alias("a"), F.col("content").alias("x")), "a").join(
            content.select(F.col("node").alias("b"), F.col("content").alias("y")), "b").select(
            "a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "verified")
        discard(pairs, content)
        return out

    return verify


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, lines): the numbers of the lines that go, from 0, for documents that lose any."""
    lines = stored(map_batches(_keyed(docs), _line_rows, "doc_id long, text_hash long, line long, node long"), "lines")
    postings = packed(text_columns(docs, "text"), _postings,
                      "key long, node long, class int, rank int, indexed boolean, parity long")
    # Of two lines that are both indexed at a key, each pair once.
    once = lambda a, b: ~F.col(f"{b}_indexed") | (F.col(f"{a}_node") < F.col(f"{b}_node"))
    alike = lambda a, b: F.bit_count(F.col(f"{a}_parity").bitwiseXOR(F.col(f"{b}_parity"))) <= 2 * THRESHOLD
    # Where each line stands first; a line that is everywhere is one row a task before the shuffle.
    firsts = stored(lines.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("p"),
                                              F.count("*").alias("n")), "firsts")
    labels = link(postings, _verify(docs, firsts), once, alike, ["parity"])
    # Only lines that occur again, or have near copies, can go.
    nodes = stored(firsts.join(labels, "node", "left").where(
        "n > 1 OR label IS NOT NULL").withColumn("label", F.coalesce("label", "node")), "nodes")
    heads = nodes.groupBy("label").agg(F.min("p").alias("head"))
    heads = stored(nodes.join(heads, "label").select("node", "head"), "heads")
    discard(firsts, nodes)
    gone = lines.join(heads, "node").where(~F.struct("doc_id", "text_hash", "line").eqNullSafe(F.col("head")))
    out = stored(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines")), "gone")
    discard(lines, heads)
    return out


def dedup(docs: DataFrame, counts: tuple[str, str] | None = None) -> DataFrame:
    """The documents without repeated lines, all other columns as they are; ``counts`` names two further columns:
    how many lines each text had and lost."""
    gone = repeated(docs)
    hash_, id_, text_, lines_ = unused(docs, "hash_", "id_", "text_", "lines_")
    own = docs.withColumn(hash_, F.xxhash64("text"))
    drops = gone.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(text_), F.col("lines").alias(lines_))
    # As many rows as documents that lose lines: a shuffle join at any size.
    joined = own.join(drops.hint("merge"),
                      own["doc_id"].eqNullSafe(F.col(id_)) & (own[hash_] == F.col(text_)), "left")

    def rebuild(batches):
        for part in tb.slices(batches):
            texts, drops = part.column("text").to_pylist(), part.column(lines_).to_pylist()
            n_lines, lost = [], []
            for i, (text, drop) in enumerate(zip(texts, drops, strict=True)):
                n_lines.append(0 if text is None else text.count("\n") + 1)
                lost.append(len(drop or ()))
                if drop:
                    bad = set(drop)
                    texts[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in bad)
            names = [c for c in part.schema.names if c != lines_]
            columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names]
            if counts:
                columns += [pa.array(n_lines, pa.int64()), pa.array(lost, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *(counts or ())])

    return map_whole(joined.select(*[F.col(f"`{c}`") for c in docs.columns], lines_), rebuild,
                     ("text", lines_), (lines_,), counts or ())
