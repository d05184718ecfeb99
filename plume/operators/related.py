"""Related discussions (K7): one class per document, with verified members.

Two documents are related when they share a band of their MinHash signatures
and at least ``RATIO`` of the words of either are words of both (Jaccard ratio
of the word sets). Classes are the connected components: if A is related to B
and B to C, all three are one class, named by its smallest doc_id.

1. One pass over the texts gives every document its MinHash signature and a
   digest of its word set. Documents with the same set are one node, so copies
   cost nothing.
2. Band postings (key, node) are stored; keys with one node are left out.
3. The smallest node of a key is its leader. Every node is compared with the
   leaders of its keys, which joins most classes already.
4. Nodes of one key that are still in different classes are compared pair by
   pair; nodes of one class need no comparison. Both sides of that join are
   stored tables, so adaptive execution splits a hot key.
5. Pairs are compared by a byte of each signature value first. A pair with
   ratio RATIO agrees in 58 of 96 values, give or take five; fewer than
   AGREE rule it out (one in 200,000 such pairs). Only the words of documents in
   pairs that remain are read again, and the ratio is counted exactly.
6. Labels are carried over the verified links to a fixpoint.

Every step reads stored tables; nothing is collected.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .text import word_tokens

# Fixed parameters of the signature (ours): BANDS bands of ROWS values each. A pair with ratio RATIO shares a band with
# probability 1 - (1 - 0.6 ** 4) ** 24 = 0.964, one with 0.7 with 0.998, one with 0.1 with 0.002.
RATIO = 0.6
BANDS = 24
ROWS = 4
PRIME = 2147483647
AGREE = 36
#: Words that a worker hashes at a time, each different one once.
LOT = 1 << 18


def multipliers() -> list[tuple[int, int]]:
    """The hash functions (a * x + b) mod PRIME, from md5 of their number."""
    def number(name: str) -> int:
        return int(hashlib.md5(name.encode()).hexdigest()[:7], 16)

    return [(number(f"a{i}") | 1, number(f"b{i}")) for i in range(BANDS * ROWS)]


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, set, bands, sketch), a row per row with words and id: number of distinct words, a digest of them, the keys
    of the signature's bands and a byte of each of its values, by crc32 of the words. A text's words are folded where it
    is read: each word is hashed once a lot of texts, and a text takes the least value of its words' rows."""
    factors, added = (np.array(c, np.int64) for c in zip(*multipliers(), strict=True))
    bands, rows, prime, lot = BANDS, ROWS, PRIME, LOT
    names = ["key", "n", "u", "v", "bands", "sketch"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column("t")), 0).to_numpy().astype(np.int64)
            kept = np.flatnonzero(size)
            if not len(kept):
                continue
            size, coded = size[kept], batch.column("t").flatten().dictionary_encode()
            word, words = coded.indices.to_numpy(), [w.encode() for w in coded.dictionary.to_pylist()]
            x = np.array([zlib.crc32(w) for w in words], np.int64)
            digest = np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in words), np.int64).reshape(-1, 2)
            ends = np.cumsum(size)
            starts = ends - size
            least = np.empty((len(kept), bands * rows), np.int32)
            first = 0
            while first < len(kept):
                last = max(first + 1, int(np.searchsorted(ends, starts[first] + lot, side="right")))
                least[first:last] = values(x, word[starts[first]:ends[last - 1]], starts[first:last] - starts[first])
                first = last
            ids = batch.column("key").take(pa.array(kept))
            keys = pa.ListArray.from_arrays(np.arange(len(kept) + 1, dtype=np.int32) * bands, band_keys(least).ravel())
            bytes_ = [r.tobytes() for r in (least & 255).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(size), *[pa.array(np.bitwise_xor.reduceat(
                digest[word, c], starts)) for c in range(2)], keys, pa.array(bytes_, pa.binary())], names=names)

    def values(x: np.ndarray, word: np.ndarray, starts: np.ndarray) -> np.ndarray:
        used = np.zeros(len(x), bool)
        used[word] = True
        words, place = x[used], (np.cumsum(used) - 1)[word]
        table = np.empty((len(words), len(factors)), np.int32)
        for at in range(0, len(words), 1 << 10):
            h = words[at:at + (1 << 10), None] * factors + added
            for _ in range(2):  # 2 ** 31 is 1 modulo PRIME, 2 ** 31 - 1
                h = (h & prime) + (h >> 31)
            h[h == prime] = 0
            table[at:at + (1 << 10)] = h
        out = np.empty((len(starts), len(factors)), np.int32)
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(word)], strict=True)):
            np.take(table, place[a:b], axis=0).min(axis=0, out=out[i])
        return out

    def band_keys(least: np.ndarray) -> np.ndarray:
        part = least.astype(np.uint64).reshape(len(least), bands, rows)
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), part.shape[:2])
        for r in range(rows):
            key = (key ^ part[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
            key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            key = key ^ (key >> np.uint64(31))
        return key.view(np.int64)

    type_ = docs.schema[key].dataType.simpleString()
    folded = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.array_distinct(word_tokens(text)).alias("t")).mapInArrow(
        fold, f"key {type_}, n bigint, u bigint, v bigint, bands array<bigint>, sketch binary")
    return folded.select(F.col("key").alias(key), "n", F.struct("n", "u", "v").alias("set"), "bands", "sketch")


def band_postings(nodes: DataFrame) -> DataFrame:
    """(key, node, n): one row per band of each node's signature."""
    return nodes.select("node", "n", F.explode("bands").alias("key"))


def _may_relate(a: Column, b: Column) -> Column:
    """Sets of sizes a and b can reach the ratio only if the smaller one is no smaller than that share of the larger."""
    return F.least(a, b) >= RATIO * F.greatest(a, b)


def verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, space: Workspace, key: str, text: str) -> DataFrame:
    """Of the pairs (a, b) those whose word sets reach the ratio, stored."""
    of = lambda table, p, value: table.select(F.col(table.columns[0]).alias(p), F.col(value).alias(f"{p}_{value}"))
    close = pairs.join(of(sketches, "a", "sketch"), "a").join(of(sketches, "b", "sketch"), "b")
    least, width = AGREE, BANDS * ROWS

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, width) for c in ("a_sketch", "b_sketch"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    near = space.put(close.select("a", "b", "a_sketch", "b_sketch").mapInArrow(alike, pairs.select("a", "b").schema))
    wanted = near.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    numbers = F.array_distinct(F.transform(word_tokens(text), lambda w: F.xxhash64(w)))
    words = space.put(docs.select(key, text).join(wanted, key).select(key, numbers.alias("words")))
    both = near.join(of(words, "a", "words"), "a").join(of(words, "b", "words"), "b")
    shared = F.size(F.array_intersect("a_words", "b_words"))
    return space.put(both.where(shared >= RATIO * (F.size("a_words") + F.size("b_words") - shared)).select("a", "b"), near, words)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def carried_labels(links: DataFrame, space: Workspace) -> DataFrame:
    """(node, label): the smallest node of the component, for each node with a link (a, b).

    A round takes the smallest label among a node's neighbours, then that
    label's own label; a star of links settles in one round, a chain of n in
    about log n. Each round replaces the stored table of the one before."""
    ends = space.put(links.select("a", "b").union(links.select("b", "a")))
    now = space.put(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        offered = ends.join(now.select(F.col("node").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        met = now.join(offered, "node").select("node", "label", F.least("label", "l").alias("seen"))
        beyond = now.select(F.col("node").alias("seen"), F.col("label").alias("further"))
        after = space.put(met.join(beyond, "seen").select("node", F.least("seen", "further").alias("label"), (F.least("seen", "further") < F.col("label")).alias("moved")))
        still = after.where("moved").isEmpty()
        space.drop(now)
        now = after.select("node", "label")
        now._stored_at = after._stored_at
        if still:
            space.drop(ends)
            return now


def one_row_each(docs: DataFrame, space: Workspace, key: str, text: str) -> DataFrame:
    """Ids that stand in several rows are usually few; stored first, they are known to be, and no text is shuffled."""
    again = space.put(docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key))
    return docs.join(again, key, "left_anti").union(docs.join(again, key, "left_semi").groupBy(key).agg(F.max(text).alias(text)))


def related_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, class_size): one row per row of the table. Documents without words are classes of their own; a
    document without an id has no class; of several rows with one id the one with the greatest text counts."""
    space = Workspace(docs.sparkSession, "related")
    rows, docs = docs.select(key), one_row_each(docs.select(key, text), space, key, text)
    check = lambda pairs: verified(pairs, sketches, docs, space, key, text)
    signed = space.put(signatures(docs, key, text))
    heads = signed.groupBy("set").agg(F.min(key).alias("node"))
    nodes = signed.withColumnRenamed(key, "node").join(heads, ["set", "node"])  # one document of each word set
    postings = space.put(band_postings(nodes))
    sketches = space.put(nodes.select("node", "sketch"))
    sets = space.put(signed.select(key, "set"), signed)
    met = postings.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last")
    members = space.put(postings.join(met, "key").select("key", "leader", "node", "n"), postings)
    leaders = members.where("node = leader").select("key", F.col("n").alias("leader_n"))
    tried = space.put(members.where("node <> leader").join(leaders, "key").where(_may_relate(F.col("n"), F.col("leader_n")))
                      .select(*_pair("node", "leader")).distinct())
    links = check(tried)
    labels = carried_labels(links, space)
    # Only the keys that still hold several classes go on.
    classed = space.put(members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label")), members)
    mixed = classed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    left = space.put(classed.join(mixed, "key"), classed)
    other = left.select("key", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "label")])
    across = left.join(other, "key").where((F.col("label") < F.col("o_label")) & _may_relate(F.col("n"), F.col("o_n")))
    more = check(space.put(across.select(*_pair("node", "o_node")).distinct().join(tried, ["a", "b"], "left_anti"), left, tried))
    if not more.isEmpty():
        again = carried_labels(links.union(more), space)
        space.drop(labels)
        labels = again
    space.drop(links)
    space.drop(more)
    of_set = sets.groupBy("set").agg(F.min(key).alias("node")).join(labels, "node", "left").select("set", F.coalesce("label", "node").alias("class_id"))
    of_key = sets.join(space.put(of_set), "set").select(key, "class_id")
    classed = space.put(rows.join(of_key, key, "left").select(key, F.coalesce("class_id", key).alias("class_id")))
    size = space.put(classed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")))
    return classed.join(size, "class_id", "left").select(key, "class_id", F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"))
