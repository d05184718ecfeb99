"""Embedding near-copies by an epsilon grid order join (operator 12).

Two vectors link when their cosine is 0.9 or more. As unit vectors they are
then at most ``eps = sqrt(2 - 2 * 0.9)`` apart, and so are their projections
onto any orthogonal directions.

1. Equal vectors are counted once: a table of different vectors, each with the
   number of its copies, which are linked with each other.
2. The different vectors are sorted by length (of the array), then by the eps
   grid cells of their leading principal components, and cut into blocks of
   neighbours, each with the box of its projections.
3. Intervals of blocks are joined recursively, from all blocks down: a pair of
   intervals is opened to the pairs of its parts unless the boxes are more
   than eps apart. Every round is an equi-join on interval numbers.
4. The block pairs that remain are compared, one pair a row: the same recursion
   goes on down to leaves of :data:`LEAF` vectors, whose dot products are taken
   in single precision, and again in double precision where they come near 0.9.
   A pair of blocks gives each vector's number of links, and only as many links
   as connect what is connected (a spanning forest), never all pairs.
5. Labels are carried over the forests to the smallest id.

The principal directions come from :data:`SAMPLE` vectors at most; they decide
what can be skipped, never what links. Vectors that are null, empty, zero or
hold a null or a non-finite component link with nothing, and so do vectors of
different lengths. Rows with one vec_id are vectors of their own; a null id is
no id: it is the component's only if no other is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plume.llm.common import stored
from plume.llm.linking import components

COSINE = 0.9
EPS = (2 - 2 * COSINE) ** 0.5
#: Vectors used to find the principal directions, at most.
SAMPLE = 4096
#: Principal directions used by the grid and the boxes.
DIRECTIONS = 8
#: Vectors and bytes of vectors in a block, at most.
BLOCK_ROWS = 1 << 14
BLOCK_BYTES = 4 << 20
#: Parts of an interval of blocks.
FAN = 8
LEAF = 256
#: Room for rounding when boxes are compared.
SLACK = 1e-4


def near_copies(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    kind = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"
    rows = stored(packed(vectors, kind), "vectors")
    nodes = stored(rows.where("vector IS NOT NULL").groupBy("vector").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least")), "different")
    basis = principal(nodes, kind)
    ordered = stored(grid_order(nodes, basis, kind), "ordered")
    blocks = stored(in_blocks(ordered, basis, kind), "blocks")
    compared = stored(compare(blocks, near_blocks(blocks), basis, kind), "compared")
    links = compared.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = stored(components(compared.where("b IS NOT NULL").select("a", "b")), "components")
    known = stored(placed(ordered).join(links, "node", "left").join(labels, "node", "left").select(
        "vector", "least", F.coalesce("label", "node").alias("label"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")), "linked")
    smallest = stored(known.groupBy("label").agg(F.min("least").alias("component_id")), "smallest")
    named = stored(known.join(smallest, "label").select("vector", "n_links", "component_id"), "named")
    out = rows.join(named, "vector", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.col("vec_id").eqNullSafe(own).alias("kept"))


def packed(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id and the vector's bytes as single-precision numbers, or as double ones where the table has such; null where
    it links with nothing."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast(f"array<{'float' if kind == 'f4' else 'double'}>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            flat = pc.fill_null(pc.list_flatten(column), np.nan).to_numpy(zero_copy_only=False)
            first = np.cumsum(size) - size
            out: list[bytes | None] = [None] * batch.num_rows
            for n in np.unique(size[size > 0]):
                at = np.flatnonzero(size == n)
                matrix = flat[first[at][:, None] + np.arange(n)] + flat.dtype.type(0)  # no negative zeros
                top = np.abs(matrix).max(axis=1)
                good = np.flatnonzero(np.isfinite(top) & (top > 0))
                if kind == "f8":  # squares must not overflow
                    matrix[good] /= top[good, None]
                for i in good:
                    out[at[i]] = matrix[i].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vector"])

    return rows.mapInArrow(run, "vec_id long, vector binary")


def units(vectors: list[bytes], kind: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) of each vector length."""
    size = np.fromiter(map(len, vectors), np.int64, len(vectors))
    out = []
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        matrix = np.frombuffer(b"".join([vectors[i] for i in at]), kind).reshape(len(at), -1).astype(np.float64)
        matrix /= np.abs(matrix).max(axis=1, keepdims=True)
        out.append((at, matrix / np.linalg.norm(matrix, axis=1, keepdims=True)))
    return out


def principal(nodes: DataFrame, kind: str) -> np.ndarray:
    """Leading principal directions, as columns, of a bounded sample of the most frequent vector length."""
    sample = nodes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return np.zeros((1, 0))
    _, matrix = max(units(sample.column("vector").to_pylist(), kind), key=lambda u: len(u[0]))
    centred = matrix - matrix.mean(axis=0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    return directions[:, ::-1][:, :DIRECTIONS].copy()


def projected(matrix: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Projections onto the basis, and the length of what they leave: maps that never move two vectors further apart.
    For vectors of another length the basis is cut or filled with zeros, which keeps that true."""
    n = min(len(basis), matrix.shape[1])
    onto = matrix[:, :n] @ basis[:n]
    if matrix.shape[1] != len(basis):
        return np.hstack([onto, np.zeros((len(matrix), 1))])  # the rest is bounded for an orthogonal basis only
    return np.hstack([onto, np.sqrt(np.maximum(0, 1 - (onto ** 2).sum(axis=1)))[:, None]])


def grid_order(nodes: DataFrame, basis: np.ndarray, kind: str) -> DataFrame:
    """Vectors, dealt out and sorted by length and grid cells; ``part`` and ``at`` number them in that order."""
    shared = nodes.sparkSession.sparkContext.broadcast(basis)  # at most DIRECTIONS vectors

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grid = [None] * batch.num_rows
            for at, matrix in units(batch.column("vector").to_pylist(), kind):
                found = np.floor(projected(matrix, shared.value)[:, :-1] / EPS).astype(np.int32)
                for i, cell in zip(at, found):
                    grid[i] = cell
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(grid, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part)),
                                              pa.array(np.arange(at, at + batch.num_rows))], names=[*batch.schema.names, "part", "at"])
            at += batch.num_rows

    schema = "vector binary, copies long, least long"
    dealt = nodes.select("vector", "copies", "least").mapInArrow(cells, f"{schema}, cell array<int>").select(
        "vector", "copies", "least", F.length("vector").alias("size"), "cell",
        F.xxhash64("vector").alias("spread"))  # a cell may hold any number of vectors
    key = ["size", "cell", "spread"]
    return dealt.repartitionByRange(*key).sortWithinPartitions(*key).drop("cell", "spread").mapInArrow(
        number, f"{schema}, size int, part long, at long")


def placed(ordered: DataFrame) -> DataFrame:
    """Adds ``node``, the vector's number in grid order: one number a partition is added up by the driver."""
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in sizes]).tolist()
    starts = ordered.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part long, before long")
    return ordered.join(F.broadcast(starts), "part").withColumn("node", F.col("before") + F.col("at"))  # a row a partition


def in_blocks(ordered: DataFrame, basis: np.ndarray, kind: str) -> DataFrame:
    """One row per block of neighbours with vectors of one length: the first one's number, vectors, copies and box."""
    shared = ordered.sparkSession.sparkContext.broadcast(basis)
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / F.col("size"))))
    numbered = placed(ordered).withColumn("group", F.floor(F.col("node") / rows))
    gathered = numbered.groupBy("size", "group").agg(
        F.sort_array(F.collect_list(F.struct("node", "copies", "vector"))).alias("rows"))  # BLOCK_ROWS, BLOCK_BYTES at most
    body = gathered.select(F.col("rows")[0]["node"].alias("block"), "size", F.col("rows.copies").alias("copies"),
                           F.col("rows.vector").alias("vectors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            boxes = []
            for vectors in batch.column("vectors").to_pylist():
                box = projected(units(vectors, kind)[0][1], shared.value)
                boxes.append((box.min(axis=0), box.max(axis=0)))
            ends = [pa.array([box[k] for box in boxes], pa.list_(pa.float64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *ends], names=[*batch.schema.names, "low", "high"])

    return body.mapInArrow(run, "block long, size int, copies array<bigint>, vectors array<binary>, low array<double>, high array<double>")


def near_blocks(blocks: DataFrame) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks whose boxes are at most EPS apart, opened from the top down. Interval i of level
    l holds the blocks from vector ``i * BLOCK_ROWS * FAN ** l`` on."""
    spark = blocks.sparkSession
    last = blocks.agg(F.max("block")).first()[0] or 0
    width = lambda level: BLOCK_ROWS * FAN ** level
    level = blocks.select("block", F.col("block").alias("number"), "low", "high", F.col("size").alias("least"), F.col("size").alias("most"))
    levels = [stored(level.withColumn("above", F.floor(F.col("block") / width(1))), "interval")]
    while last // width(len(levels)):
        sides = levels[-1].select("above", "least", "most", F.posexplode(F.arrays_zip("low", "high")))
        box = sides.groupBy("above", "pos").agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"),
                                                F.min("least").alias("least"), F.max("most").alias("most"))
        whole = box.groupBy("above").agg(F.sort_array(F.collect_list(F.struct("pos", "low", "high"))).alias("box"),
                                         F.min("least").alias("least"), F.max("most").alias("most"))
        levels.append(stored(whole.select(F.col("above").alias("number"), F.col("box.low").alias("low"), F.col("box.high").alias("high"), "least", "most",
                                          F.floor(F.col("above") / FAN).alias("above")), "interval"))
    pairs = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    square = lambda a, b: F.greatest(a, b, F.lit(0.0)) * F.greatest(a, b, F.lit(0.0))
    for level in reversed(levels):
        side = lambda p: level.select(*[F.col(c).alias(f"{p}_{c}") for c in ("number", "above", "low", "high", "least", "most")])  # noqa: E731, B023
        opened = pairs.join(side("x"), F.col("a") == F.col("x_above")).join(side("y"), F.col("b") == F.col("y_above")).where("x_number <= y_number")
        below, over = (F.zip_with(f"{p}_low", f"{q}_high", lambda a, b: a - b) for p, q in ("xy", "yx"))
        gap = F.aggregate(F.zip_with(below, over, square), F.lit(0.0), lambda total, part: total + part)
        near = opened.where((gap <= (EPS + SLACK) ** 2) & (F.col("x_least") <= F.col("y_most")) & (F.col("y_least") <= F.col("x_most")))
        pairs = stored(near.select(F.col("x_number").alias("a"), F.col("y_number").alias("b")), "pairs")
    return pairs


def compare(blocks: DataFrame, pairs: DataFrame, basis: np.ndarray, kind: str) -> DataFrame:
    """(a, null, n): vector a has n links found in one pair of blocks; (a, b, null): a and b are connected, as far as
    needed to connect what the pair of blocks connects. The blocks of a pair reach a task one after the other."""
    shared = blocks.sparkSession.sparkContext.broadcast(basis)
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    dealt = sides.join(blocks.select("block", "copies", "vectors"), "block").repartition("a", "b").sortWithinPartitions("a", "b", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                a, b, at = (row.column(c)[0].as_py() for c in ("a", "b", "block"))
                block = Block(at, row.column("copies")[0].values.to_numpy(), row.column("vectors")[0].as_py(), kind, shared.value)
                if a == b:
                    yield join_blocks(block, block)
                elif at == a:
                    first = block
                else:
                    yield join_blocks(first, block)

    return dealt.mapInArrow(run, "a long, b long, n long")


class Block:
    def __init__(self, at: int, copies: np.ndarray, vectors: list[bytes], kind: str, basis: np.ndarray) -> None:
        self.node, self.copies = at + np.arange(len(copies)), copies
        self.exact = units(vectors, kind)[0][1]
        self.quick = self.exact.astype(np.float32)
        self.box = projected(self.exact, basis)
        self.links = np.zeros(len(copies), np.int64)

    def span(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        part = self.box[low:high]
        return part.min(axis=0), part.max(axis=0)


def join_blocks(x: Block, y: Block) -> pa.RecordBatch:
    """The epsilon grid order recursion within two blocks, or one with itself."""
    if x.exact.shape[1] != y.exact.shape[1]:
        return pa.RecordBatch.from_arrays([pa.nulls(0, pa.int64())] * 3, names=["a", "b", "n"])
    shift = len(x.node) if y is not x else 0
    forest = Forest(len(x.node) + (len(y.node) if shift else 0))
    margin = max(1e-5, x.exact.shape[1] * 2.0 ** -22)  # beyond any rounding of single precision

    def leaf(a0: int, a1: int, b0: int, b1: int) -> None:
        dots = x.quick[a0:a1] @ y.quick[b0:b1].T
        i, j = np.nonzero(dots >= COSINE - margin)
        if x is y and a0 == b0:
            i, j = i[i < j], j[i < j]
        unsure = np.flatnonzero(dots[i, j] < COSINE + margin)
        if len(unsure):
            true = np.einsum("nd,nd->n", x.exact[a0 + i[unsure]], y.exact[b0 + j[unsure]]) >= COSINE
            keep = np.ones(len(i), bool)
            keep[unsure[~true]] = False
            i, j = i[keep], j[keep]
        if len(i):
            i, j = i + a0, j + b0
            x.links += np.bincount(i, y.copies[j], len(x.node)).astype(np.int64)
            y.links += np.bincount(j, x.copies[i], len(y.node)).astype(np.int64)
            forest.join(i, j + shift)

    def halves(low: int, high: int) -> list[tuple[int, int]]:
        if high - low <= LEAF:
            return [(low, high)]
        middle = low + LEAF * max(1, (high - low) // LEAF // 2)
        return [(low, middle), (middle, high)]

    def recur(a0: int, a1: int, b0: int, b1: int) -> None:
        (al, ah), (bl, bh) = x.span(a0, a1), y.span(b0, b1)
        if (np.maximum(np.maximum(al - bh, bl - ah), 0) ** 2).sum() > (EPS + SLACK) ** 2:
            return
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            return leaf(a0, a1, b0, b1)
        for a in halves(a0, a1):
            for b in halves(b0, b1):
                if x is not y or a[0] <= b[0]:
                    recur(*a, *b)

    recur(0, len(x.node), 0, len(y.node))
    parts = [x] if y is x else [x, y]
    names, n = np.concatenate([p.node for p in parts]), np.concatenate([p.links for p in parts])
    a, b = (names[e] for e in forest.edges())
    node, n = names[n > 0], n[n > 0]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([node, np.minimum(a, b)])),
        pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(np.maximum(a, b))]),
        pa.concat_arrays([pa.array(n), pa.nulls(len(a), pa.int64())])], names=["a", "b", "n"])


class Forest:
    """Components of the vectors of a pair of blocks, by the smallest place."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            if (a == b).all():
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """An edge for each vector that is not its component's first. Within a component it stands for a path of links."""
        at = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.root[at], at

