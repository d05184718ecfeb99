"""Packed postings against a plain grouping, in whole ranges and in parts."""

import numpy as np
import pytest

from plume.llm import linking

SCHEMA = "key long, node long, class int, rank int, indexed boolean, parity long"


def made(part):
    """Postings of test rows: the text is the seed."""
    out = {c: [] for c in ("key", "node", "class", "rank", "indexed", "parity")}
    for seed in part.column("text").to_pylist():
        rng = np.random.default_rng(int(seed))
        n = 200
        out["key"].append(np.where(rng.random(n) < 0.1, 7, rng.integers(-2**63, -2**63 + 3000, n) + rng.integers(0, 2, n) * (2**62 + 11)))
        out["node"].append(rng.integers(0, 400, n))
        out["class"].append(np.zeros(n, int))
        out["rank"].append(np.zeros(n, int))
        out["indexed"].append(rng.random(n) < 0.3)
        out["parity"].append(np.full(n, int(seed)))
    return {c: np.concatenate(v) for c, v in out.items()}


def plain(seeds):
    import pyarrow as pa

    p = made(pa.RecordBatch.from_pydict({"text": [str(s) for s in seeds]}))
    by = {}
    for key, node, indexed in zip(p["key"].tolist(), p["node"].tolist(), p["indexed"].tolist()):
        nodes = by.setdefault(key, {})
        nodes[node] = nodes.get(node, False) or indexed
    return {(k, n, i) for k, nodes in by.items() if len(nodes) > 1 for n, i in nodes.items()}, by


@pytest.mark.parametrize("sort", [linking.SORT, 500])
def test_shared_postings(spark, sort):
    seeds = range(60)
    df = spark.createDataFrame([(str(s),) for s in seeds], "text string").repartition(4)
    want, by = plain(seeds)
    any_ = {k for k, nodes in by.items() if any(nodes.values())}
    # The limit goes to the workers with the function.
    function = linking.shared_postings.__code__
    shared = linking.shared_postings if sort == linking.SORT else type(linking.shared_postings)(function, dict(vars(linking), SORT=sort))
    rows = [(r["key"], r["node"], r["indexed"]) for r in shared(linking.packed(df, made, SCHEMA)).collect()]
    if sort == linking.SORT:
        assert len(rows) == len(set(rows)) and set(rows) == {r for r in want if r[0] in any_}
    else:  # parts: rows may repeat, none that is wanted is missing, an indexed node is there as such
        assert {r for r in want if r[0] in any_} <= set(rows) and {r[:2] for r in rows} <= {r[:2] for r in want}


def test_no_postings(spark):
    df = spark.createDataFrame([], "text string")
    assert linking.shared_postings(linking.packed(df, made, SCHEMA)).collect() == []
