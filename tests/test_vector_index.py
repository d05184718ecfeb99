"""Search for many queries (K6): exact blocks against numpy, the index by its recall."""

import numpy as np
import pytest

from plume.operators import vector_index as VI
from plume.plans import catalog

from .conftest import SF_MID

SF_LARGE = "/root/testdata/sf0.1"
SCHEMA = "vec_id bigint, embedding array<float>"


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def brute(rows, asked, k):
    out = []
    for q, x in asked:
        scored = []
        for i, v in rows:
            if v is not None and None not in v and len(v) == len(x) and np.isfinite(v).all() and any(v) and any(x):
                a, b = np.array(v, float), np.array(x, float)
                scored.append((-round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 6), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def clustered(n, dim=16, groups=12, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    return [(i, (centre[i % groups] + 0.4 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def queries(df, every):
    return df.where(f"vec_id % {every} = 0").selectExpr("vec_id AS query_id", "embedding AS query")


@pytest.mark.parametrize("block", [VI.BLOCK, 7])
def test_exact_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(VI, "BLOCK", block)
    rows = clustered(600)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = VI.search_exact(df, queries(df, 10), 5)
    assert rows_of(got) == brute(rows, [r for r in rows if r[0] % 10 == 0], 5)


def test_ties_go_by_id(spark):
    rows = [(i, [1.0, float(i % 2)]) for i in range(400, 0, -1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(VI.search_exact(df, queries(df, 100), 4)) == brute(rows, [r for r in rows if r[0] % 100 == 0], 4)


def recall(got, want):
    truth = {}
    for q, _, i, s in want:
        truth.setdefault(q, {})[i] = s
    hit = sum(s >= min(truth[q].values()) for q, _, _, s in got)
    return hit / sum(len(t) for t in truth.values())


@pytest.mark.parametrize("sf", [SF_MID, SF_LARGE])
def test_recall_of_the_index_on_the_test_vectors(spark, sf):
    got, want = (rows_of(catalog.queries()[n](spark, sf)) for n in ("semantic_index", "semantic_search"))
    assert recall(got, want) >= 0.95
    best = {(q, i): s for q, _, i, s in want}
    assert all(abs(best[q, i] - s) < 1e-6 for q, _, i, s in got if (q, i) in best)  # scores are exact


def test_recall_with_a_hot_cell(spark):
    """Half of all vectors are copies of one, in one cell and many packs."""
    rows = clustered(3000) + [(3000 + i, np.eye(16)[0].tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    index = VI.build_index(df, cells=24)
    assert index.packs.selectExpr("sum(size(ids))").first()[0] == 6000
    assert index.packs.groupBy("cell").count().agg({"count": "max"}).first()[0] > 1
    got = VI.search_index(index, df, queries(df, 50), 10, probe=4)
    assert recall(rows_of(got), rows_of(VI.search_exact(df, queries(df, 50), 10))) >= 0.95


def test_more_probes_find_more(spark):
    df = spark.createDataFrame(clustered(2000, dim=32, groups=1), SCHEMA)
    index = VI.build_index(df, cells=32)
    want = rows_of(VI.search_exact(df, queries(df, 40), 10))
    shares = [recall(rows_of(VI.search_index(index, df, queries(df, 40), 10, probe=p)), want) for p in (1, 8, 32)]
    assert shares[0] < shares[1] < shares[2] and shares[2] >= 0.99


@pytest.mark.parametrize("search", ["exact", "index"])
def test_odd_vectors_and_empty_tables(spark, search):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 0.0, 0.0]),
            (9, []), (10, [0.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    run = VI.search_exact if search == "exact" else lambda v, q, k: VI.search_index(VI.build_index(v, cells=2), v, q, k, probe=2)
    asked = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.5, 1.0])]
    ask = spark.createDataFrame([*asked, (4, None), (None, [1.0, 0.0])], "query_id bigint, query array<double>")
    assert rows_of(run(df, ask, 3)) == brute(rows, asked, 3)
    assert run(df.limit(0), ask, 3).collect() == [] and run(df, ask.limit(0), 3).collect() == []
