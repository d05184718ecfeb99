"""N-gram Jaccard join, size-aware: documents link when their sets of
five-word shingles have a Jaccard similarity of 0.8 or more.

All sets order their shingles alike, rare ones first (by counts in
2**:data:`ORDER_BITS` hashed buckets over the whole corpus, then by hash; any
order is right, this one keeps widely shared shingles out of the way). Two
sets that link share one shingle among the first ``s - ceil(0.8 s) + 1`` of
each, and two among the first ``s - ceil(0.8 s) + 2``. Sets up to a boundary
enumerate the two-shingle subsets of the latter and meet at equal subsets;
larger ones scan the inverted lists of the former, on which sets that are
just small enough to link with a large one stand too (as the smaller set of a
pair, with its first ``s - ceil(8 s / 9) + 1`` only). The boundary is where
the estimated rows and candidates of both ways add up to the least.

Equal sets are one node from the start. Candidates are narrowed by an exact
upper bound (shingle counts in 128 buckets), then verified on whole sets;
:mod:`plume.llm.linking` turns links into components.

Words are runs of characters other than blank and \\x09-\\x0D, A-Z
lower-cased. Defined results: a text of one to four words has one shingle;
null and empty texts have none, link with nothing and are their own
component; rows with equal texts are linked whatever their ids; component_id
is the smallest id in the component, null if none has one. Shingles and sets
are told apart by 64-bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import discard, map_batches, map_whole, stored, text_columns, tidy, unused
from plume.llm.linking import bits_of, link, may_hold, packed

SHINGLE = 5
ORDER_BITS = 18
BUCKETS = 128
#: Bits of the parities that rule pairs out when all of a key's nodes meet.
PARITIES = 512
#: Rows that verifying one candidate costs, for the choice of the boundary.
VERIFY_COST = 50
#: Sizes above this always scan lists.
MAX_LIGHT = 64


def prefix(size: np.ndarray) -> np.ndarray:
    """Shingles among which two sets that link share one: s - ceil(0.8 s) + 1."""
    return size - (4 * size + 4) // 5 + 1


def _sets(texts: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (shingle, text), by text and shingle."""
    value, text = tb.shingles(tb.words(texts, fold=True), SHINGLE)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[fresh], text[fresh]


def _nodes(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set, as a signed number."""
    one = np.concatenate([[tb.U64(0)], np.cumsum(tb.mix(value ^ tb.U64(0x5851F42D4C957F2D)), dtype=tb.U64)])
    total = one[bounds[1:]] - one[bounds[:-1]]
    return tb.mix(total ^ np.diff(bounds).astype(tb.U64)).astype(np.int64)


def _summaries(part: pa.RecordBatch) -> dict:
    """A row for each document."""
    texts = tb.as_texts(part.column("text"))
    value, text = _sets(texts)
    n = len(texts)
    bounds = np.searchsorted(text, np.arange(n + 1))
    bucket = (value & tb.U64(BUCKETS - 1)).astype(np.int64) + text * BUCKETS
    sketch = np.bincount(bucket, minlength=n * BUCKETS).clip(max=255).astype(np.uint8).reshape(n, BUCKETS)
    # Bit c: whether the set has an odd number of shingles of class c.
    odd = np.bincount((value & tb.U64(PARITIES - 1)).astype(np.int64) + text * PARITIES, minlength=n * PARITIES) & 1
    parities = np.packbits(odd.astype(np.uint8).reshape(n, PARITIES), axis=1).view(np.int64)
    return {"doc_id": part.column("doc_id"), "n_shingles": np.diff(bounds), "node": _nodes(value, bounds),
            "sketch": [row.tobytes() for row in sketch],
            "parities": pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * (PARITIES // 64), parities.ravel())}


def _order_counts(docs: DataFrame) -> np.ndarray:
    """Shingles of all documents by order bucket: 2**ORDER_BITS numbers, however large the corpus."""
    def run(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for part in tb.slices(batches):
            value, _ = _sets(tb.as_texts(part.column("text")))
            total += np.bincount((value >> tb.U64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    rows = text_columns(docs, "text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def boundary(sizes: dict[int, int], counts: np.ndarray) -> int:
    """The largest size that enumerates subsets, by least estimated cost.

    A light set costs its subsets; a heavy one its list entries and, for each,
    the candidates that a list of mean length gives.
    """
    total = counts.sum()
    usual = counts[counts <= counts.mean() + 6 * np.sqrt(counts.mean() + 1)].astype(float)
    # Mean list length from the buckets' second moment, freed of what chance puts together.
    mean = usual.mean() if len(usual) else 0.0
    length = 1.0 + max(0.0, usual.var() / mean - 1.0) if total and mean else 1.0
    best, at = None, 0
    for light in range(0, MAX_LIGHT + 1):
        cost = 0.0
        for size, n in sizes.items():
            one = int(prefix(np.array(size)))
            if size <= light:
                cost += n * (one + 1) * one / 2
            if size > light or 5 * size >= 4 * (light + 1):
                cost += n * one * (1 + VERIFY_COST * (length - 1) / 2 * (size > light))
        if best is None or cost < best:
            best, at = cost, light
    return at


def index_prefix(size: np.ndarray) -> np.ndarray:
    """Shingles among which a set shares one with a larger or equal one that links: s - ceil(8 s / 9) + 1."""
    return size - (8 * size + 8) // 9 + 1


def _postings(part: pa.RecordBatch, counts: np.ndarray, light: int) -> dict:
    texts = tb.as_texts(part.column("text"))
    value, text = _sets(texts)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    node = _nodes(value, bounds)
    # Bit c: whether the set has an odd number of shingles of class c.
    flips = np.concatenate([[tb.U64(0)], np.bitwise_xor.accumulate(tb.U64(1) << (value & tb.U64(63)))]) if len(value) else \
        np.zeros(1, tb.U64)
    parity = (flips[bounds[1:]] ^ flips[bounds[:-1]]).astype(np.int64)
    # Equal sets of a slice post once.
    own = np.zeros(len(texts), bool)
    own[np.unique(node, return_index=True)[1]] = True
    size = np.diff(bounds)
    mine = own[text]
    value, text = value[mine], text[mine]
    order = np.lexsort((value, counts[(value >> tb.U64(64 - ORDER_BITS)).astype(np.int64)], text))
    value, text = value[order], text[order]
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    rank = np.arange(len(value)) - first[text]
    own_size = size[text]
    listed = (rank < prefix(own_size)) & ((own_size > light) | (5 * own_size >= 4 * (light + 1)))
    keys, of, ranks = [value[listed]], [text[listed]], [rank[listed] + 1]
    for i in np.flatnonzero((size <= light) & (size >= 4) & own):
        head = value[first[i]:first[i] + int(prefix(size[i])) + 1]
        a, b = np.triu_indices(len(head), 1)
        keys.append(tb.mix(head[a] * tb.U64(0x9E3779B97F4A7C15) + tb.mix(head[b])))
        of.append(np.full(len(a), i))
        ranks.append(np.zeros(len(a), np.int64))
    key, of, ranks = np.concatenate(keys), np.concatenate(of), np.concatenate(ranks)
    own_size = size[of]
    return {"key": key.astype(np.int64), "node": node[of], "size": own_size, "rank": ranks,
            "class": np.floor(np.log(np.maximum(own_size, 1)) / np.log(1.25)).astype(np.int64),
            "indexed": (ranks == 0) | (ranks <= index_prefix(own_size)), "parity": parity[of]}


def _may_link(light: int):
    def condition(a: str, b: str):
        x, y, i, j = (F.col(f"{p}_{c}") for c in ("size", "rank") for p in (a, b))
        # The indexed set is the smaller one; of equal sizes, the one with the smaller number, unless only it is indexed.
        order = (x < y) | ((x == y) & (~F.col(f"{b}_indexed") | (F.col(f"{a}_node") < F.col(f"{b}_node"))))
        # On a list, the first common shingle leaves room for enough further ones.
        room = 1 + F.least(x - i, y - j)
        return order & ((i == 0) == (j == 0)) & (
            (i == 0) | (((x > light) | (y > light)) & (9 * room >= 4 * (x + y))))

    return condition


def _alike(a: str, b: str):
    """Sets that link differ in a ninth of their shingles at most, and each of those flips one bit."""
    x, y = F.col(f"{a}_size"), F.col(f"{b}_size")
    apart = F.bit_count(F.col(f"{a}_parity").bitwiseXOR(F.col(f"{b}_parity")))
    return (5 * F.least(x, y) >= 4 * F.greatest(x, y)) & (9 * apart <= x + y)


def _late_alike(a: str, b: str):
    """As the parity in :func:`_alike`, by classes so many that it tells larger sets apart too."""
    apart = sum(F.bit_count(F.col(f"{a}_parities")[k].bitwiseXOR(F.col(f"{b}_parities")[k])) for k in range(PARITIES // 64))
    return 9 * apart <= F.col(f"{a}_size") + F.col(f"{b}_size")


def _verify(docs: DataFrame, summaries: DataFrame):
    """Pairs of nodes to those that link: by sketches, then by whole sets."""
    known = summaries.where("n_shingles > 0")

    def bounded(pairs: DataFrame) -> DataFrame:
        nodes = stored(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(),
                       "nodes")
        facts = stored(known.join(nodes, "node", "left_semi").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "facts")
        one = lambda p: facts.select(F.col("node").alias(p), F.col("n").alias(f"n_{p}"), F.col("sketch").alias(f"s_{p}"))

        def room(batches):
            for part in batches:
                n = part.column("n_a").to_numpy() + part.column("n_b").to_numpy()
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, BUCKETS) for c in ("s_a", "s_b"))
                full = (a == 255).any(axis=1) | (b == 255).any(axis=1)  # a bucket that may hold more bounds nothing
                keep = full | (9 * np.minimum(a, b).sum(axis=1, dtype=np.int64) >= 4 * n)
                yield part.select(["a", "b"]).filter(pa.array(keep))

        left = stored(pairs.join(one("a"), "a").join(one("b"), "b").mapInArrow(room, "a long, b long"), "pairs")
        discard(nodes)
        return left, facts

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            return pairs
        left, facts = bounded(pairs)
        nodes = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct()
        ids = bits_of(facts.join(nodes, "node", "left_semi").select(F.xxhash64("doc_id").alias("key")))
        discard(facts)
        wanted = docs.sparkSession.sparkContext.broadcast(ids)  # 2**FILTER_BITS bits
        texts = text_columns(docs, "doc_id", "text").select(F.xxhash64("doc_id").alias("key"), "text")

        def whole(part: pa.RecordBatch) -> dict:
            part = part.filter(pa.array(may_hold(part.column("key").to_numpy(), wanted.value)))
            value, text = _sets(tb.as_texts(part.column("text")))
            bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
            return {"node": _nodes(value, bounds), "set": [value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]}

        # One document stands for each node. Rows with one id may hold several texts, and the bits let a few others
        # through: a set may come twice then, and so may a pair. Both joins read one shuffle of the sets, so that they
        # take disk once and are not stored beside it.
        sets = map_batches(texts, whole, "node long, set binary")

        def compare(batches):
            for part in batches:
                keep = []
                for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True):
                    a, b = np.frombuffer(x, tb.U64), np.frombuffer(y, tb.U64)
                    shared = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * shared >= 80 * (len(a) + len(b) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        out = stored(left.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(
            compare, "a long, b long").distinct(), "verified")
        discard(pairs, left)
        return out

    return verify


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, and ``set_id`` (null without shingles) of each document."""
    summaries = stored(map_batches(text_columns(docs, "doc_id", "text"), _summaries,
                                   "doc_id long, n_shingles long, node long, sketch binary, parities array<bigint>"), "summaries")
    counts = _order_counts(docs)
    by_size = summaries.where("n_shingles > 0").groupBy(F.least("n_shingles", F.lit(4 * MAX_LIGHT)).alias("size")).count()
    light = boundary({r["size"]: r["count"] for r in by_size.collect()}, counts)  # 4 * MAX_LIGHT rows at most
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # 2**ORDER_BITS numbers
    tidy(docs.sparkSession)
    postings = packed(text_columns(docs, "text"), lambda part: _postings(part, shared.value, light),
                      "key long, node long, size int, rank int, class int, indexed boolean, parity long")
    late = summaries.where("n_shingles > 0").groupBy("node").agg(F.first("parities").alias("parities"))
    labels = link(postings, _verify(docs, summaries), _may_link(light), _alike, ["size", "parity"], late, _late_alike)
    filled = summaries.where("n_shingles > 0").select("doc_id", "n_shingles", "node")
    named = stored(filled.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    smallest = stored(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    alone = summaries.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("set_id"))
    return named.join(smallest, "label").select("doc_id", "n_shingles", "component_id", F.col("node").alias("set_id")) \
        .unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns; documents without
    shingles stay. Of rows with one id and set, one stays; a component without any id keeps one row of each set."""
    found = stored(classes(docs), "classes")
    heads = found.where("n_shingles = 0 OR doc_id <=> component_id")
    keep = stored(heads.groupBy("doc_id").agg(F.count("*").alias("n")), "keep")
    id_ = docs["doc_id"]
    keep_, set_, node_ = unused(docs, "keep_", "set_", "node_")
    pick = lambda ids: docs.join(ids.select(F.col("doc_id").alias(keep_)), id_.eqNullSafe(F.col(keep_)), "left_semi")
    one, several = pick(keep.where("n = 1")), keep.where("n > 1")
    if several.isEmpty():
        return one

    def named(batches):
        for part in tb.slices(batches):
            value, text = _sets(tb.as_texts(part.column("text")))
            bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
            node = pa.array(_nodes(value, bounds), mask=np.diff(bounds) == 0)
            yield pa.RecordBatch.from_arrays([*part.columns, node], names=[*part.schema.names, node_])

    sets = heads.select(F.col("doc_id").alias(keep_), F.col("set_id").alias(set_)).distinct()
    more = map_whole(pick(several), named, longs=(node_,)).join(
        sets, F.col("doc_id").eqNullSafe(F.col(keep_)) & F.col(node_).eqNullSafe(F.col(set_)), "left_semi")
    more = more.where(F.col(node_).isNull()).unionByName(
        more.where(F.col(node_).isNotNull()).dropDuplicates(["doc_id", node_]))
    return one.unionByName(more.drop(node_))
