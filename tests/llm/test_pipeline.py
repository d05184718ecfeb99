"""The pipeline's rows against plain versions of its stages, each on the rows before it."""

import re

import corpus_pipeline as cp
from plume.llm import line_dedup as ld, quality_rules
from plume.llm.common import stored
from tests.llm import test_decontaminate, test_jaccard_join, test_line_dedup, test_quality_rules

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    frames, now = {}, docs
    for name, stage in cp.STAGES:
        now = frames[name] = stored(stage(spark, now, SF), name)
        if name != "piece_lattice":
            assert now.columns == docs.columns
    rules = pairs(frames["quality_rules"])
    verdict = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    assert sorted(rules) == sorted((i, t) for i, t in pairs(docs) if verdict[i]["kept"])
    assert not any(test_quality_rules.brute(t)[-1] for _, t in rules)
    lines = [(i, t) for i, t in test_line_dedup.brute(spark, rules, lambda a, b: 0 if ld.within(a, b) else 99)
             if re.search(r"[^\x20\x09-\x0D]", t)]
    assert sorted(pairs(frames["line_dedup"])) == sorted(lines)
    assert all(r["n_chars"] == len(r["text"]) for r in frames["line_dedup"].collect())
    want, _ = test_jaccard_join.brute(lines)
    heads = {i for i, n, c in want if not n or i == c}
    copies = [(i, t) for i, t in lines if i in heads]
    assert sorted(pairs(frames["jaccard_join"])) == sorted(copies)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in test_decontaminate.brute(copies, items)}
    clean = [(i, t) for i, t in copies if i not in bad]
    assert sorted(pairs(frames["decontaminate"])) == sorted(clean)
    last = frames["piece_lattice"].collect()
    assert sorted(r["doc_id"] for r in last) == sorted(i for i, _ in clean)
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) > 0 for r in last)
