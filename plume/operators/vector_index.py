"""Search by meaning for many queries (K6): exact in blocks, or through an index.

**Exact** (:func:`search_exact`). The queries stay a table. They are numbered
into blocks of at most ``BLOCK``; one block at a time is read and broadcast,
and every task keeps the best k of its rows for each query of the block, so a
task ships ``BLOCK * k`` rows at most.

**Index** (:func:`build_index`, :func:`search_index`). K-means cells are fitted
on a bounded sample. Every vector goes to its nearest cell and is stored there
as one byte per component of its residual, in packs of one cell. A query goes
to its ``probe`` nearest cells, as many as the wanted recall takes within the
sample; packs of queries meet packs of vectors by an
equi-join on the cell, which adaptive execution splits where a cell is hot;
each meeting gives the best few by the bytes, and these few are scored exactly
by a join with the vectors themselves.

Similarity is the cosine, rounded to six places; ties go by id. A vector that
is null, zero, not finite or of another length than the query is similar to
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .similarity import cosine

#: Queries broadcast at a time, and rows scored against them at a time.
BLOCK = 2048
ROWS = 1024
#: Vectors of the sample that the cells are fitted on, at most; cells at most; rounds of k-means.
SAMPLE = 65_536
MAX_CELLS = 1024
ROUNDS = 8
#: Vectors and queries in a pack, at most.
PACK = 1024
QUERY_PACK = 256


def units(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, unit vectors) of the vectors that are similar to anything; of one length, ``dim`` or the first one's."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = pc.fill_null(pc.list_flatten(column).cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    dim = dim or next((int(n) for n in size if n), 1)
    at = np.flatnonzero(size == dim)
    matrix = flat[(np.cumsum(size) - size)[at][:, None] + np.arange(dim)] if len(at) else np.zeros((0, dim))
    with np.errstate(over="ignore", invalid="ignore"):
        top = np.abs(matrix).max(axis=1, initial=0)
        good = np.isfinite(top) & (top > 0)
    matrix = matrix[good] / top[good, None]
    return at[good], matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _numbered(queries: DataFrame, space: Workspace) -> DataFrame:
    """Adds ``block``: rows of one partition, BLOCK at most."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            block = (np.arange(at, at + batch.num_rows) // BLOCK) + (part << 32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=[*batch.schema.names, "block"])
            at += batch.num_rows

    kept = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("query").cast("array<double>").alias("query"))
    kept = kept.where(F.col("query").isNotNull() & F.col("query_id").isNotNull())
    return space.put(kept.coalesce(max(1, kept.count() // BLOCK)).mapInArrow(number, "query_id bigint, query array<double>, block bigint"))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row: highest score, then smallest id."""
    if scores.shape[1] > 4 * k:  # everything that ties with the k-th stays for the sort
        edge = np.partition(scores, -k, axis=1)[:, -k]
        keep = (scores >= edge[:, None]).any(axis=0)
        scores, ids = scores[:, keep], ids[keep]
    by = np.lexsort((np.broadcast_to(ids, scores.shape), -scores))[:, :k]
    return np.take_along_axis(scores, by, axis=1), ids[by]


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = np.hstack([a[0], b[0]]), np.hstack([a[1], b[1]])
    by = np.lexsort((ids, -scores))[:, :k]
    return np.take_along_axis(scores, by, axis=1), np.take_along_axis(ids, by, axis=1)


def search_exact(vectors: DataFrame, queries: DataFrame, k: int = 10, vec: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """For each query (``query_id``, ``query``) the k most similar vectors: id, query_id, score, rank."""
    spark = vectors.sparkSession
    space = Workspace(spark, "search")
    numbered = _numbered(queries, space)
    blocks = [r["block"] for r in numbered.select("block").distinct().orderBy("block").collect()]  # a number for BLOCK queries
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).alias("vector")).where(F.col("id").isNotNull())
    found = []
    for block in blocks:
        part = numbered.where(F.col("block") == block).toArrow().combine_chunks()  # BLOCK queries at most
        shared = spark.sparkContext.broadcast(part.to_batches()[0] if part.num_rows else None)
        found.append(space.put(rows.mapInArrow(lambda batches, shared=shared: _scan(batches, shared.value, k),
                                               "query_id bigint, id bigint, score double")))
    schema = "query_id bigint, id bigint, score double"
    every = spark.read.schema(schema).parquet(*[f._stored_at for f in found]) if found else spark.createDataFrame([], schema)
    return _ranked(every, k, id_col)


def _ranked(found: DataFrame, k: int, id_col: str) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k).select(
        F.col("id").alias(id_col), "query_id", "score", "rank")


def _scan(batches: Iterator[pa.RecordBatch], queries: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
    by_length = {}
    lengths = pc.list_value_length(queries.column("query")).to_numpy()
    for n in np.unique(lengths[lengths > 0]):
        at, matrix = units(queries.column("query"), int(n))
        if len(at):
            by_length[int(n)] = queries.column("query_id").to_numpy()[at], matrix, [np.zeros((len(at), 0)), np.zeros((len(at), 0), np.int64)]
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            ids = part.column("id").to_numpy()
            for n, (_, matrix, best) in by_length.items():
                at, rows = units(part.column("vector"), n)
                if len(at):
                    best[:] = _merged(best, _best(np.round(matrix @ rows.T, 6), ids[at], k), k)
    for query, _, (scores, ids) in by_length.values():
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query, scores.shape[1])), pa.array(ids.ravel()), pa.array(scores.ravel())],
                                         names=["query_id", "id", "score"])


@dataclass
class Index:
    """Cell centres (``MAX_CELLS`` at most), the stored packs (cell, ids, codes of a byte a component, scale), and how
    many cells a query visits for the wanted recall."""

    centres: np.ndarray
    packs: DataFrame
    probe: int


def build_index(vectors: DataFrame, cells: int | None = None, recall: float = 0.97, vec: str = "embedding", id_col: str = "vec_id") -> Index:
    """The index over all vectors that are similar to anything; of the length that is most frequent in the sample."""
    spark = vectors.sparkSession
    space = Workspace(spark, "index")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().combine_chunks()
    column = sample.column("vector").chunk(0) if sample.num_rows else pa.array([], pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    dim = int(np.bincount(lengths).argmax()) or 1 if len(lengths) else 1
    known = units(column, dim)[1]
    centres = fit_cells(known, cells or min(MAX_CELLS, max(1, round(n ** 0.5))))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, matrix = units(batch.column("vector"), dim)
            cell = nearest(matrix, shared.value, 1)[:, 0] if len(shared.value) else np.zeros(0, np.int64)
            rest = matrix - shared.value[cell] if len(at) else matrix
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), pa.array(cell.astype(np.int32)),
                                              pa.array([r.astype(np.float32).tobytes() for r in rest], pa.binary())], names=["id", "cell", "rest"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, part in _runs(batches, PACK):
            rest = np.frombuffer(b"".join(part.column("rest").to_pylist()), np.float32).reshape(part.num_rows, -1)
            scale = float(np.abs(rest).max(initial=1e-12)) / 127
            yield pa.RecordBatch.from_arrays([
                pa.array([cell], pa.int32()), pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                pa.array([np.rint(rest / scale).astype(np.int8).tobytes()], pa.binary()), pa.array([scale])], names=["cell", "ids", "codes", "scale"])

    dealt = rows.mapInArrow(assign, "id bigint, cell int, rest binary").withColumn("spread", F.xxhash64("id"))
    dealt = dealt.repartitionByRange("cell", "spread").sortWithinPartitions("cell", "spread").drop("spread")
    packs = space.put(dealt.mapInArrow(pack, "cell int, ids array<bigint>, codes binary, scale double"))
    return Index(centres, packs, cells_to_visit(known, centres, recall))


def cells_to_visit(sample: np.ndarray, centres: np.ndarray, recall: float, k: int = 10, asked: int = 256) -> int:
    """How many of its nearest cells a query visits to find that share of its k best: measured within the sample. Among
    more vectors the best ones are nearer, so it is enough for them too."""
    if not len(sample):
        return 1
    queries = sample[np.linspace(0, len(sample) - 1, min(asked, len(sample))).astype(int)]
    best = np.argsort(-(queries @ sample.T), axis=1)[:, :k]
    cell = nearest(sample[best.ravel()], centres, 1).reshape(best.shape)
    order = nearest(queries, centres, len(centres))
    place = np.argsort(order, axis=1)  # of each cell in the query's order
    return int(np.quantile(np.take_along_axis(place, cell, axis=1), recall, method="higher")) + 1


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows sorted by cell, cut into pieces of one cell."""
    for batch in batches:
        cell = batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
        for low, high in zip(cuts, cuts[1:]):
            for at in range(low, high, limit):
                yield int(cell[at]), batch.slice(at, min(limit, high - at))


def fit_cells(sample: np.ndarray, cells: int) -> np.ndarray:
    """K-means by Lloyd's rounds, from evenly drawn rows of the sample; a cell that runs empty keeps its centre."""
    if not len(sample):
        return np.zeros((0, sample.shape[1]))
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)].copy()
    for _ in range(ROUNDS):
        cell = np.concatenate([nearest(sample[i:i + 4096], centres, 1)[:, 0] for i in range(0, len(sample), 4096)])
        count = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, sample)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest cells of each vector."""
    far = (centres ** 2).sum(axis=1) - 2 * vectors @ centres.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


def search_index(index: Index, vectors: DataFrame, queries: DataFrame, k: int = 10, probe: int | None = None, few: int = 4,
                 vec: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """As :func:`search_exact`, among the vectors of the ``probe`` nearest cells (by default the index's number); the ``few * k`` best by their bytes are
    scored exactly."""
    spark = vectors.sparkSession
    space = Workspace(spark, "probe")
    shared, dim, probe = spark.sparkContext.broadcast(index.centres), index.centres.shape[1], probe or index.probe
    asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("query").cast("array<double>").alias("query")) \
        .where("query_id IS NOT NULL AND query IS NOT NULL")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, matrix = units(batch.column("query"), dim)
            if not len(at) or not len(shared.value):
                continue
            cell = nearest(matrix, shared.value, probe)
            body = [m.astype(np.float32).tobytes() for m in matrix]
            which = np.repeat(np.arange(len(at)), cell.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("query_id").to_numpy()[at][which]), pa.array(cell.ravel().astype(np.int32)),
                                              pa.array([body[i] for i in which], pa.binary())], names=["query_id", "cell", "body"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, part in _runs(batches, QUERY_PACK):
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([part.column("query_id").to_pylist()], pa.list_(pa.int64())),
                                              pa.array([b"".join(part.column("body").to_pylist())], pa.binary())], names=["cell", "query_ids", "bodies"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked_ids, ids = np.array(row["query_ids"]), np.array(row["ids"])
                body = np.frombuffer(row["bodies"], np.float32).reshape(len(asked_ids), -1)
                codes = np.frombuffer(row["codes"], np.int8).reshape(len(ids), -1).astype(np.float32) * np.float32(row["scale"])
                scores, best = _best(body @ (codes + shared.value[row["cell"]].astype(np.float32)).T, ids, few * k)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked_ids, scores.shape[1])), pa.array(best.ravel()),
                                                  pa.array(scores.ravel().astype(np.float64))], names=["query_id", "id", "near"])

    sent = asked.mapInArrow(send, "query_id bigint, cell int, body binary").withColumn("spread", F.xxhash64("query_id"))
    packs = space.put(sent.repartitionByRange("cell", "spread").sortWithinPartitions("cell", "spread").drop("spread")
                      .mapInArrow(pack, "cell int, query_ids array<bigint>, bodies binary"))
    met = index.packs.join(packs, "cell").mapInArrow(meet, "query_id bigint, id bigint, near double")
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), F.asc("id"))
    chosen = space.put(met.withColumn("r", F.row_number().over(order)).where(F.col("r") <= few * k).select("query_id", "id"))
    own = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("vector"))
    scored = chosen.join(own, "id").join(asked, "query_id").select(
        "query_id", "id", F.round(cosine(F.col("vector"), F.col("query")), 6).alias("score")).where("score IS NOT NULL")
    return _ranked(scored, k, id_col)
