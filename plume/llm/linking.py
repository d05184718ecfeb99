"""Connected components of a similarity join, without all pairs of a group.

Candidates come as postings: (key, node, ...), where any two nodes that may
link share a key. A first round compares each node with one leader of its
key (and class) only, and joins what links into components; most groups of
near copies become one component here. A second round compares, for keys that
still hold more than one component, the nodes of different components. Pairs
within a component need no comparison: they are connected already. So no link
between components is lost, and no group is expanded into all its pairs.

Most keys belong to one node only. They are told apart before postings become
rows: postings travel as packed arrays (:func:`packed`), dealt out by ranges of
keys, and each task sorts the keys of one range at a time. Only postings whose
key holds several nodes come out as rows.

Groups are split by Spark: both sides of the joins are stored tables, so
adaptive execution can split a hot key, and all groupings are sums, minima or
maxima that are taken before the shuffle too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from plume.llm import textbatch
from plume.llm.common import discard, pa_schema, release, stored, tidy

#: Postings that a task packs at a time, and that it sorts at a time.
PACK = 1 << 19
SORT = 1 << 22

#: Bits of the table that tells wanted keys from others without a shuffle: 8 MB. Where more keys are wanted than it
#: can tell apart it lets more through; the result is the same.
FILTER_BITS = 26


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over edges (a, b), for every node that has an edge.

    Each round, a node takes the smallest label around it and then its
    label's label, until nothing changes; every round is written to the
    shared folder. The number of rounds grows with the logarithm of the
    components' width in practice, and the loop only ends when labels rest.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        around = both.join(near, "b").groupBy("a").agg(F.min("near").alias("near"))
        moved = stored(labels.join(around, labels["node"] == around["a"]).select(
            "node", "label", F.least("label", "near").alias("next")), "labels")
        # A label is itself a node, so its own label is as small or smaller.
        jump = moved.select(F.col("node").alias("there"), F.col("next").alias("jump"))
        after = stored(moved.join(jump, moved["next"] == jump["there"]).select(
            "node", F.least("next", "jump").alias("label"), (F.least("next", "jump") < F.col("label")).alias("fell")), "labels")
        discard(labels, moved)
        if after.where("fell").isEmpty():
            discard(both)
            return after.select("node", "label")
        labels = after


def bits_of(keys: DataFrame) -> np.ndarray:
    """A bit for each ``key`` in a table of 2**FILTER_BITS, put together by Spark: 2**FILTER_BITS / 64 numbers at most
    come to the driver, however many keys there are."""
    rows = keys.select(F.shiftrightunsigned("key", 70 - FILTER_BITS).cast("int").alias("word"),
                       F.expr("shiftleft(1L, cast(key & 63 AS int))").alias("bits")).groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint64)


def may_hold(key: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether the table has the bit of each key; true for every key that went in."""
    key = key.view(np.uint64)
    word = (key >> np.uint64(70 - FILTER_BITS)).astype(np.int64)
    return (table[word] >> (key & np.uint64(63))) & np.uint64(1) > 0


@dataclass
class Packed:
    """Postings as arrays: a row per range of keys and lot, with the bytes of each column."""

    table: DataFrame
    schema: pa.Schema


def _kinds(schema: pa.Schema) -> dict[str, type]:
    return {f.name: np.bool_ if pa.types.is_boolean(f.type) else f.type.to_pandas_dtype() for f in schema}


def packed(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text") -> Packed:
    """As ``common.map_batches``, with the postings of every task packed by ranges of their ``key``: as many ranges as
    shuffle partitions."""
    spark = df.sparkSession
    target = pa_schema(spark, schema)
    kinds = _kinds(target)
    ranges = min(1 << 15, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: list[dict] = []
        n = 0
        for part in textbatch.slices(batches, column):
            lots.append({c: np.asarray(v, kinds[c]) for c, v in function(part).items()})
            n += len(lots[-1]["key"])
            if n >= PACK:
                yield from rows(lots)
                lots, n = [], 0
        if n:
            yield from rows(lots)
        lots.clear()
        release()

    def rows(lots: list[dict]) -> Iterator[pa.RecordBatch]:
        columns = {c: np.concatenate([lot[c] for lot in lots]) for c in kinds}
        place = ((columns["key"].view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.uint16)
        order = np.argsort(place, kind="stable")
        columns = {c: v[order] for c, v in columns.items()}
        cuts = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=ranges))])
        held = np.flatnonzero(np.diff(cuts))
        for some in np.split(held, range(64, len(held), 64)):
            bodies = [pa.array([v[cuts[k]:cuts[k + 1]].tobytes() for k in some], pa.binary()) for v in columns.values()]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *bodies], names=["range", *columns])

    return Packed(df.mapInArrow(run, ", ".join(["range int", *[f"{c} binary" for c in kinds]])), target)


def shared_postings(postings: Packed) -> DataFrame:
    """The postings of keys that hold several nodes, at least one of them indexed, each once.

    A task takes one range at a time. A range of more than SORT postings is sorted in parts: what has met another node
    leaves, and two postings a key stay for the next part, so memory follows the keys and no hot key is held. (Then
    postings may come out twice, and keys without an indexed node: more rows, the same links.)"""
    schema = postings.schema
    kinds = _kinds(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n, cut = None, [], 0, False
        for batch in batches:
            for i, place in enumerate(batch.column("range").to_pylist()):
                if place != now:
                    if n:
                        yield found(joined(held), not cut)
                    now, held, n, cut = place, [], 0, False
                held.append({c: np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in kinds.items()})
                n += len(held[-1]["key"])
                if n >= SORT:
                    part = joined(held)
                    yield found(part, False)
                    two = witnesses(part)
                    held, n, cut = [{c: v[two] for c, v in part.items()}], len(two), True
        if n:
            yield found(joined(held), not cut)
        held.clear()
        release()

    def joined(held: list[dict]) -> dict:
        """One table, by key, the indexed postings of a key first."""
        part = {c: np.concatenate([lot[c] for lot in held]) for c in kinds}
        order = np.argsort(~part["indexed"], kind="stable")
        order = order[np.argsort(part["key"][order], kind="stable")]
        return {c: v[order] for c, v in part.items()}

    def heads(key: np.ndarray) -> np.ndarray:
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        return np.flatnonzero(fresh)

    def witnesses(part: dict) -> np.ndarray:
        """A posting of each key, and one of another node where there is one: whatever comes then meets another node."""
        start = heads(part["key"])
        size = np.diff(np.append(start, len(part["key"])))
        other = part["node"] != np.repeat(part["node"][start], size)
        second = np.minimum.reduceat(np.where(other, np.arange(len(other)), len(other)), start)
        return np.concatenate([start, second[second < len(other)]])

    def found(part: dict, whole: bool) -> pa.RecordBatch:
        start = heads(part["key"])
        wanted = np.minimum.reduceat(part["node"], start) != np.maximum.reduceat(part["node"], start)
        if whole:
            wanted &= part["indexed"][start]
        pick = np.repeat(wanted, np.diff(np.append(start, len(part["key"]))))
        out = {c: v[pick] for c, v in part.items()}
        by = np.lexsort((~out["indexed"], out["rank"], out["node"], out["key"]))
        fresh = np.ones(len(by), bool)
        fresh[1:] = np.any([out[c][by][1:] != out[c][by][:-1] for c in ("key", "node", "rank")], axis=0)
        return pa.RecordBatch.from_arrays([pa.array(out[f.name][by[fresh]], f.type) for f in schema], schema=schema)

    dealt = postings.table.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, from_arrow_schema(schema))


def link(postings: DataFrame | Packed, verify: Callable[[DataFrame], DataFrame], may_link: Callable[[str, str], Column],
         alike: Callable[[str, str], Column], carry: list[str], late: DataFrame | None = None,
         late_alike: Callable[[str, str], Column] | None = None) -> DataFrame:
    """(node, label) of all nodes that link with another.

    ``postings``: key, node, class, rank, indexed, and the columns in
    ``carry``; of two nodes that may link, one is ``indexed`` at a shared key.
    The leader of a key is the indexed node with the smallest rank.
    ``alike(a, b)``: a condition on the carried columns of two nodes, given
    their name prefixes, that holds for all that link. ``may_link(a, b)``: a
    further one on two postings, the first one indexed. ``late``: further
    columns of nodes (by ``node``), too wide to carry all the way, and
    ``late_alike`` on them, for the second round. ``verify``: of pairs (a, b),
    a < b, those that link.
    """
    if isinstance(postings, Packed):
        members = stored(shared_postings(postings), "members")
        tidy(members.sparkSession)
    else:
        postings = stored(postings, "postings")
        shared = postings.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"),
                                             F.max("indexed").alias("any")).where("lo <> hi AND any").select("key")
        members = stored(postings.join(shared, "key"), "members")
        discard(postings)
    leaders = stored(members.where("indexed").groupBy("key", "class").agg(
        F.min(F.struct("rank", "node", *carry)).alias("l")).select(
        "key", "class", F.col("l.node").alias("l_node"), *[F.col(f"l.{c}").alias(f"l_{c}") for c in carry]), "leaders")
    own = members.select("key", "class", *[F.col(c).alias(f"m_{c}") for c in ("node", *carry)])
    first = stored(own.join(leaders, ["key", "class"]).where((F.col("m_node") != F.col("l_node")) & alike("m", "l")).select(
        F.least("m_node", "l_node").alias("a"), F.greatest("m_node", "l_node").alias("b")).distinct(), "pairs")
    discard(leaders)
    links = stored(verify(first), "links")
    labels = components(links)
    # A shuffle join at any size: as many labels as nodes that link.
    named = stored(members.join(labels.hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node")), "members")
    discard(members)
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    still = named.join(mixed, "key")
    if late is not None:
        still = still.join(late, "node")
    open_ = stored(still, "members")
    discard(named)
    carry = [*carry, *([c for c in late.columns if c != "node"] if late is not None else [])]
    side = lambda p: open_.select("key", *[F.col(c).alias(f"{p}_{c}") for c in ("node", "label", "rank", "indexed", *carry)])
    meet = (F.col("x_label") != F.col("y_label")) & may_link("x", "y") & alike("x", "y")
    across = side("x").where("x_indexed").join(side("y"), "key").where(meet & late_alike("x", "y") if late_alike else meet)
    second = across.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
    more = stored(verify(second.join(first, ["a", "b"], "left_anti")), "links")
    discard(open_, first)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    discard(links, more)
    return labels
