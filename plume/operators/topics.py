"""Topic models and large vocabularies (K5, K2) as joins and aggregates.

**Topics** (:func:`fit_topics`). A latent Dirichlet model fitted by expectation
maximisation with Dirichlet priors. Nothing of the model is held by the driver.
Words are known by 64-bit hashes, all of them, and named again by a join at the
end. Documents are dealt to blocks of bounded size once, words to slices by
hash. In a round every block splits its (document, word) counts among the
topics and sends each slice the sums of its words; a slice adds up what blocks
found and gives each block the weights of the words that stand in it. So counts
stay where they are and a word moves once a block, not once a document; the log
posterior that blocks add up on the way never falls from round to round.

**Vocabularies** (:func:`term_mentions`). The terms are a table. Texts give
their n-grams, of the lengths that terms have, and these meet the terms in one
equi-join: the cost of a text does not depend on the number of terms, and
adaptive execution decides whether the terms are broadcast.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from ..functions import lexicon as L
from ..session import Workspace
from .text import word_tokens

# The functions below travel with their code: workers may lack this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed parameters (ours): pseudo-counts of the priors on a document's topics and on a topic's words.
DOC_PRIOR = 0.1
WORD_PRIOR = 0.01
# A block of documents has so many characters of text or so; the fewer blocks have a word, the less moves in a round, and a
# task holds one block's counts. Smaller inputs are cut finer, to so many blocks if these have the least size.
BLOCK_CHARS, FEW_BLOCKS, LEAST_CHARS = 400_000_000, 8, 1 << 24
# Rounds that run as one job; then the weights are stored and the shuffle files of these rounds can go.
ROUNDS_PER_JOB = 5


def model_words(text: str = "text") -> Column:
    """Words of three letters or more, without stop words."""
    stop = L.phrase_stop_words()
    return F.filter(word_tokens(F.col(text)), lambda w: ~w.isin(stop) & (F.length(w) >= 3))


@dataclass
class TopicModel:
    words: DataFrame  # word (hash), term, p0, p1, ...: the share of each topic's words
    documents: DataFrame  # key, t0, t1, ...: the share of each topic in a document
    posterior: list[float]  # log posterior before each round


def _columns(k: int, name: str) -> list[str]:
    return [f"{name}{i}" for i in range(k)]


def _first_weight(topic: int) -> Column:
    """A word's first weight in a topic, from md5 of both: between 0 and 1, the same on every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{topic}:"), F.col("term"))), 1, 7)
    return (F.conv(digits, 16, 10).cast("double") + 1) / (1 << 28)


def fit_topics(docs: DataFrame, k: int = 5, rounds: int = 10, key: str = "doc_id", text: str = "text") -> TopicModel:
    space = Workspace(docs.sparkSession, "topics")
    found = docs.select(F.explode(model_words(text)).alias("term")).select(F.xxhash64("term").alias("w"), "term").distinct()
    vocabulary = space.put(found.groupBy("w").agg(F.min("term").alias("term")))
    size = vocabulary.count()
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS), min(FEW_BLOCKS, chars // LEAST_CHARS))
    parts = 4 * blocks  # so that few blocks share a task
    numbered = _numbered(_dealt(docs, blocks, parts, key, text), blocks).persist(StorageLevel.DISK_ONLY)
    # Counts and the blocks' lists of words stay where they are for all rounds: only weights and sums of words move.
    counts = numbered.where("d IS NOT NULL").drop("slice").repartition(parts, "block").sortWithinPartitions("block").persist(StorageLevel.DISK_ONLY)
    members = numbered.where("slice IS NOT NULL").select(F.col("slice").alias("to"), "block", "words")
    members = members.repartition(parts, "to").sortWithinPartitions("to").persist(StorageLevel.DISK_ONLY)
    try:
        keys = space.put(counts.select("block", "d", F.col("key").alias(key)).distinct())
        present = members.agg(F.count_distinct("block")).first()[0]
        numbered.unpersist()
        state = space.put(_first_state(vocabulary, members, present, k, blocks, parts))
        for done in range(0, rounds, ROUNDS_PER_JOB):
            after = state
            for i in range(done, min(done + ROUNDS_PER_JOB, rounds)):
                after = _round(counts, members, after, size, k, parts, last=i + 1 == rounds)
            state = space.put(after, state)
    finally:
        for df in (numbered, counts, members):
            df.unpersist()
    logs = state.agg(*[F.sum(F.element_at("log", i + 1)) for i in range(rounds)]).first() if rounds else []
    return TopicModel(_word_shares(state, size, k).join(vocabulary, "w"),
                      _document_shares(state, k).join(keys, ["block", "d"]).select(key, *_columns(k, "t")), [x or 0.0 for x in logs])


def _dealt(docs: DataFrame, blocks: int, parts: int, key: str, text: str) -> DataFrame:
    """(block, d, key, words): a text's words as sorted hashes; d numbers a block's documents, texts of one id (or of none) as one."""
    dealt = docs.select(F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), F.col(key).alias("key"),
                        F.sort_array(F.transform(model_words(text), lambda w: F.xxhash64(w))).alias("words"))
    order = Window.partitionBy("block").orderBy("key")
    return dealt.repartition(parts, "block").withColumn("d", F.dense_rank().over(order))


def _numbered(dealt: DataFrame, slices: int) -> DataFrame:
    """A block's texts (block, d, key, words, n): numbers of words in the block's own list and how often they stand, a
    number of more than 255 in pieces; and the list (block, slice, words) as sorted hashes, cut by slices of all words."""
    schema = StructType([StructField("block", IntegerType()), StructField("slice", IntegerType()), StructField("d", IntegerType()),
                         StructField("key", dealt.schema["key"].dataType), StructField("words", BinaryType()), StructField("n", BinaryType())])

    of = pa.schema([("block", pa.int32()), ("slice", pa.int32()), ("d", pa.int32()), ("key", pa.null()), ("words", pa.binary()), ("n", pa.binary())])

    def counted(batch):
        """Of texts with words: d, key, the words once each, how often they stand and where each text's words end."""
        sizes = pc.fill_null(pc.list_value_length(batch["words"]), 0).to_numpy(zero_copy_only=False)
        x, kept = batch["words"].flatten().to_numpy(), np.flatnonzero(sizes)
        row = np.repeat(np.arange(len(kept)), sizes[kept])
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(x)))
        pieces = (n + 254) // 255
        first, m = np.repeat(first, pieces), np.full(pieces.sum(), 255)
        m[np.cumsum(pieces) - 1] = n - 255 * (pieces - 1)
        ends = np.append(0, np.cumsum(np.bincount(row[first], minlength=len(kept))))
        return batch["d"].to_numpy()[kept], batch["key"].take(pa.array(kept)), x[first], m.astype(np.uint8), ends

    def packed(values, ends):
        offsets = (ends * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])

    def number(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, known = [], np.zeros(0, np.int64)
        for batch in (b.slice(i, 4000) for b in batches for i in range(0, b.num_rows, 4000)):
            texts.append(counted(batch))
            known = np.unique(np.concatenate([known, texts[-1][2]]))
        if not len(known):
            return
        block, kind = key[0].as_py(), texts[0][1].type
        schema = of.set(3, pa.field("key", kind))
        same = lambda n: pa.array(np.full(n, block, np.int32))
        slice_of = np.mod(known, slices)
        order = np.argsort(slice_of, kind="stable")
        place = np.empty(len(known), np.int32)
        place[order] = np.arange(len(known), dtype=np.int32)
        worded = np.unique(np.concatenate([x[0] for x in texts]))  # documents without words don't count
        while texts:
            d, ids, words, n, ends = texts.pop()
            numbers = pa.array(np.searchsorted(worded, d).astype(np.int32))
            yield pa.RecordBatch.from_arrays([same(len(d)), pa.nulls(len(d), pa.int32()), numbers, ids,
                                              packed(place[np.searchsorted(known, words)], ends), packed(n, ends)], schema=schema)
        cut = np.searchsorted(slice_of[order], np.arange(slices + 1))
        lists = pa.array([known[order[i:j]].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([same(slices), pa.array(np.arange(slices, dtype=np.int32)), pa.nulls(slices, pa.int32()),
                                          pa.nulls(slices, kind), lists, pa.nulls(slices, pa.binary())], schema=schema)

    return dealt.groupBy("block").applyInArrow(number, schema)


# What moves in a round. Between blocks and slices, v holds doubles: the topics' totals over all words, the sum of the
# logarithms of the slice's weights, the number of blocks, then the weights of the words, topic by topic. Documents move as
# (to = -1 - block): their shares, topic by topic; log has the block's part of the log posterior before each round.
STATE = "block int, to int, words binary, v binary, log array<double>"


def _state_rows(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64())]
    columns = list(zip(*rows)) or [()] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "to", "words", "v", "log"])


def _spread(to: int, words: np.ndarray, weights: np.ndarray, totals: np.ndarray, present: float, lists: list, last: bool) -> pa.Table:
    """A slice's weights, for each block those of its words; after the last round the slice itself."""
    head = np.append(totals, [np.log(weights).sum(), present])
    if last:
        return _state_rows([(None, to, words.tobytes(), np.append(head, weights).tobytes(), None)])
    return _state_rows([(block, to, None, np.append(head, weights[:, np.searchsorted(words, own)]).tobytes(), None) for block, own in lists])


def _lists(table: pa.Table) -> tuple[list, np.ndarray]:
    """The blocks' lists of words in a slice, and all its words."""
    lists = sorted((block, np.frombuffer(own, np.int64)) for block, own in zip(table["block"].to_pylist(), table["words"].to_pylist()))
    return lists, np.unique(np.concatenate([own for _, own in lists]))


def _first_state(vocabulary: DataFrame, members: DataFrame, present: int, k: int, slices: int, parts: int) -> DataFrame:
    names = _columns(k, "p")
    first = vocabulary.select(F.pmod("w", F.lit(slices)).cast("int").alias("to"), "w", *[_first_weight(i).alias(p) for i, p in enumerate(names)])
    totals = [x or 0.0 for x in first.agg(*[F.sum(p) for p in names]).first()]

    def start(key, table, weights):
        if not table.num_rows:
            return _state_rows([])
        lists, words = _lists(table)
        order = np.argsort(weights["w"].to_numpy())
        values = np.array([weights[p].to_numpy()[order] for p in names]).reshape(k, len(words))
        return _spread(key[0].as_py(), words, values + WORD_PRIOR, np.array(totals), present, lists, False)

    return members.groupBy("to").cogroup(first.repartition(parts, "to").groupBy("to")).applyInArrow(start, STATE)


def _round(counts: DataFrame, members: DataFrame, state: DataFrame, size: int, k: int, parts: int, last: bool) -> DataFrame:
    """Blocks split their counts among the topics; slices add up what blocks found for a word and give it to its blocks."""

    def split(key, table, state):
        block, rows = key[0].as_py(), sorted(state.select(["to", "v", "log"]).to_pylist(), key=lambda r: r["to"])
        documents = 1 + pc.max(table["d"]).as_py()
        theta, log = np.full((k, documents), 1.0 / k), []
        if rows[0]["to"] < 0:
            theta, log = np.frombuffer(rows[0]["v"]).reshape(k, -1), rows[0]["log"]
            rows = rows[1:]
        slices = [np.frombuffer(r["v"]) for r in rows]
        totals, present = slices[0][:k] + WORD_PRIOR * size, slices[0][k + 1]
        phi = np.concatenate([x[k + 2:].reshape(k, -1) for x in slices], axis=1) / totals[:, None]
        by_word, by_document, likelihood = np.zeros(phi.shape), np.zeros(theta.shape), 0.0
        for batch in table.to_batches(max_chunksize=4000):
            sizes, d = pc.binary_length(batch["n"]).to_numpy(), batch["d"].to_numpy()
            words = np.frombuffer(b"".join(batch["words"].to_pylist()), np.int32)
            n = np.frombuffer(b"".join(batch["n"].to_pylist()), np.uint8).astype(float)
            each = [np.repeat(theta[i][d], sizes) * phi[i][words] for i in range(k)]
            s = sum(each)
            likelihood += n @ np.log(s)
            n /= s
            starts = np.append(0, np.cumsum(sizes)[:-1])
            for i in range(k):
                part = each[i] * n
                by_word[i] += np.bincount(words, part, phi.shape[1])
                by_document[i] += np.bincount(d, np.add.reduceat(part, starts), documents)
        prior = WORD_PRIOR * (sum(x[k] for x in slices) - size * np.log(totals).sum()) / present + DOC_PRIOR * np.log(theta).sum()
        theta = (by_document + DOC_PRIOR) / (by_document.sum(axis=0) + DOC_PRIOR * k)
        head, out, at = np.append(by_word.sum(axis=1), [0.0, 1.0]), [(block, -1 - block, None, theta.tobytes(), [*log, likelihood + prior])], 0
        for r, x in zip(rows, slices):
            end = at + (len(x) - k - 2) // k
            out.append((block, r["to"], None, np.append(head, by_word[:, at:end]).tobytes(), None))
            at = end
        return _state_rows(out)

    def merge(key, table, found):
        to = key[0].as_py()
        if to < 0:
            return found.select(["block", "to", "words", "v", "log"])
        lists, words = _lists(table)
        weights, head = np.full((k, len(words)), WORD_PRIOR), np.zeros(k + 2)
        sent = dict(zip(found["block"].to_pylist(), found["v"].to_pylist()))
        for block, own in lists:
            v = np.frombuffer(sent[block])
            head += v[:k + 2]
            weights[:, np.searchsorted(words, own)] += v[k + 2:].reshape(k, -1)
        return _spread(to, words, weights, head[:k], head[k + 1], lists, last)

    counted = counts.select("block", "d", "words", "n").groupBy("block")
    parted = counted.cogroup(state.repartition(parts, "block").groupBy("block")).applyInArrow(split, STATE)
    return members.groupBy("to").cogroup(parted.repartition(parts, "to").groupBy("to")).applyInArrow(merge, STATE)


def _word_shares(state: DataFrame, size: int, k: int) -> DataFrame:
    """(w, p0, p1, ...) of the slices."""

    def read(batches):
        for words, v in ((w, np.frombuffer(v)) for b in batches for w, v in zip(b["words"].to_pylist(), b["v"].to_pylist())):
            shares = v[k + 2:].reshape(k, -1) / (v[:k, None] + WORD_PRIOR * size)
            yield from pa.table([np.frombuffer(words, np.int64), *shares], names=["w", *_columns(k, "p")]).to_batches(max_chunksize=10_000)

    return state.where("to >= 0").select("words", "v").mapInArrow(read, ", ".join(["w bigint", *[f"{p} double" for p in _columns(k, "p")]]))


def _document_shares(state: DataFrame, k: int) -> DataFrame:
    """(block, d, t0, t1, ...) of the blocks."""

    def read(batches):
        for block, theta in ((w, np.frombuffer(v).reshape(k, -1)) for b in batches for w, v in zip(b["block"].to_pylist(), b["v"].to_pylist())):
            d = np.arange(theta.shape[1], dtype=np.int32)
            yield from pa.table([np.full(len(d), block, np.int32), d, *theta], names=["block", "d", *_columns(k, "t")]).to_batches(max_chunksize=10_000)

    return state.where("to < 0").select("block", "v").mapInArrow(read, ", ".join(["block int, d int", *[f"{t} double" for t in _columns(k, "t")]]))


def top_terms(model: TopicModel, n: int = 8) -> DataFrame:
    """(topic, rank, term, weight): the n heaviest words of each topic, ties by the word."""
    names = [c for c in model.words.columns if c[0] == "p" and c[1:].isdigit()]
    long = model.words.select("term", F.posexplode(F.array(*names)).alias("topic", "weight"))
    order = Window.partitionBy("topic").orderBy(F.desc(F.round("weight", 6)), F.asc("term"))
    # Held against the number itself, not the rank: so every task keeps its own n heaviest only.
    return long.withColumn("number", F.row_number().over(order)).where(F.col("number") <= n).select(
        F.col("topic").cast("int"), (F.col("number") - 1).cast("int").alias("rank"), "term", F.round("weight", 6).alias("weight"))


def term_mentions(docs: DataFrame, terms: DataFrame, lengths: Sequence[int] = (1, 2, 3, 4), key: str = "doc_id",
                  text: str = "text", term: str = "term") -> DataFrame:
    """K2 for vocabularies of any size: (key, term, mentions, first_word), one row per document and term that stands in
    it as whole words, whatever its case; ``first_word`` is the place of the first mention, words from 0, so a document's
    terms are ordered by (first_word, term). ``lengths``: words that a term may have; longer terms are not found."""
    wanted = terms.select(F.array_join(word_tokens(term), " ").alias("term")).where("term <> ''").distinct()
    # Tokens zipped with their shifted copies: every n-gram reads its own element only.
    tokens = docs.select(key, word_tokens(text).alias("t"))
    last = max(lengths)
    shifted = tokens.select(key, *[F.slice("t", i + 1, F.greatest(F.size("t"), F.lit(1))).alias(f"t{i}") for i in range(last)])
    placed = shifted.select(key, F.posexplode(F.arrays_zip(*[f"t{i}" for i in range(last)])).alias("at", "z"))
    grams = F.array(*[F.when(F.col(f"z.t{n - 1}").isNotNull(), F.concat_ws(" ", *[f"z.t{i}" for i in range(n)])) for n in lengths])
    gram = placed.select(key, "at", F.explode(grams).alias("term")).where("term IS NOT NULL")
    return gram.join(wanted, "term").groupBy(key, "term").agg(
        F.count(F.lit(1)).alias("mentions"), F.min("at").cast("bigint").alias("first_word"))
