"""The grid join against all cosines in double precision."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plume.llm import grid_join as gj, registry
from plume.plans.verify import compare, duck

SF = "/root/testdata/sf0.01"


def brute(rows):
    """[(vec_id, n_links, component_id, kept)]"""
    good = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if g else None for (_, v), g in zip(rows, good)]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and \
                    unit[i] @ unit[j] / (np.linalg.norm(unit[i]) * np.linalg.norm(unit[j])) >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, links[i], least.get(find(i)), k == least.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def own(df):
    return sorted((tuple(r) for r in gj.near_copies(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def near(rng, vector, angle):
    side = rng.normal(size=len(vector))
    side -= side @ vector / (vector @ vector) * vector
    side *= np.linalg.norm(vector) / np.linalg.norm(side)
    return math.cos(angle) * vector + math.sin(angle) * side


def planted(n=300, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            out.append(near(rng, out[rng.integers(len(out))], rng.uniform(0.3, 0.6)) * rng.uniform(0.1, 9))
        else:
            out.append(rng.normal(size=dim) + 3 * np.eye(dim)[rng.integers(3)])
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(out)]


@pytest.mark.parametrize("block_rows, leaf, fan", [(1 << 14, 256, 8), (20, 4, 2)])
def test_equals_brute_force(spark, monkeypatch, block_rows, leaf, fan):
    for name, value in (("BLOCK_ROWS", block_rows), ("FAN", fan)):
        monkeypatch.setattr(gj, name, value)  # of these the driver's values count
    rows = planted()
    want = brute(rows)
    assert 20 < len({r[2] for r in want}) < 250 and max(r[1] for r in want) > 3
    assert own(spark.createDataFrame(rows, "vec_id long, embedding array<float>")) == want
    doubles = [(i, [x * 1e200 for x in v]) for i, v in rows]  # squares overflow
    assert own(spark.createDataFrame(doubles, "vec_id long, embedding array<double>")) == want


def test_blocks_far_apart_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(gj, "BLOCK_ROWS", 10)
    rng = np.random.default_rng(5)
    rows = [(i, (10 * np.eye(8)[i % 8] + 0.2 * rng.normal(size=8)).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    nodes = gj.packed(df, "f8").groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    basis = gj.principal(nodes, "f8")
    blocks = gj.stored(gj.in_blocks(gj.stored(gj.grid_order(nodes, basis, "f8"), "ordered"), basis, "f8"), "blocks")
    assert blocks.count() >= 80 and gj.near_blocks(blocks).count() < 80 * 81 / 2 / 3
    assert own(df) == brute(rows)


def test_leaves_of_a_block_by_recursion():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (700, 300), (513, 1024)):
        sides = [rng.normal(size=(k, 6)).astype(np.float32) for k in (n, m)]
        basis = np.linalg.qr(rng.normal(size=(6, 6)))[0][:, :3]
        blocks = [gj.Block(at, np.ones(len(v), np.int64), [r.tobytes() for r in v], "f4", basis) for at, v in zip((0, n), sides)]
        gj.join_blocks(*blocks)
        cos = blocks[0].exact @ blocks[1].exact.T >= 0.9
        assert (blocks[0].links == cos.sum(axis=1)).all() and (blocks[1].links == cos.sum(axis=0)).all()


def test_the_edge_of_the_threshold_in_double_precision(spark):
    rows = []
    for k in range(40):
        angle = math.acos(0.9) + (k - 19.5) * 1e-9
        rows += [(2 * k, [1.0 + k, 0.0, 0.0, float(k)]), (2 * k + 1, near(np.random.default_rng(k), np.array([1.0 + k, 0, 0, k]), angle).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert own(df) == brute(rows)


def test_copies_are_not_expanded(spark):
    rng = random.Random(1)
    base = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, base) for i in range(3000)] + [(3000 + i, [x + rng.gauss(0, 0.01) for x in base]) for i in range(300)] + [(4000, [-x for x in base])]
    got = own(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert got == sorted([(i, 3299, 0, i == 0) for i in range(3300)] + [(4000, 0, 4000, True)], key=str)


def test_odd_vectors_repeated_ids_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, -0.0]), (8, [2.0, 0.0]),
            (8, [2.0, 0.0]), (None, [1.0, 0.1]), (None, [0.0, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-40, 0.0]), (-1, [0.0, 5.0])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, n_links int").withColumn("Component_id", F.lit("x"))
    assert own(df) == brute(rows)
    assert own(df.limit(0)) == []
    assert own(df.where("vec_id < 7 AND vec_id > 0")) == [(i, 0, i, True) for i in range(1, 7)]


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = registry.QUERIES["op12_grid_join"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    ok, detail = compare(got, duck(SF), registry.ORACLE_SQL["op12_grid_join"])
    assert ok, detail
