"""Seen filter (J2): exact, and history is never shuffled."""

import random

from plume.operators import seen as SN
from plume.session import scratch_path

SCHEMA = "source string, post_id string, n int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_equals_the_plain_anti_join(spark, monkeypatch):
    rng = random.Random(1)
    history = [(rng.choice("ab"), str(rng.randrange(5000)), k) for k in range(3000)]
    new = [(rng.choice("abc"), str(rng.randrange(5000)), k) for k in range(2000)] + [(None, "1", 1), ("a", None, 2), ("a", None, 2)]
    held = {r[:2] for r in history}
    want = sorted((r for r in new if None in r[:2] or r[:2] not in held), key=str)
    for bits in (30, 8):  # 256 bits: every post is a hit, and the exact look-up decides
        monkeypatch.setattr(SN, "BITS", bits)
        words = SN.merged(SN.seen_words(table(spark, history)))
        got = SN.unseen(table(spark, new), words, table(spark, history))
        assert got.columns == ["source", "post_id", "n"] and sorted(map(tuple, got.collect()), key=str) == want


def test_epochs_merge_and_replays_change_nothing(spark):
    path = scratch_path(spark, "seen")
    parts = [table(spark, [("a", f"{n}-{k}", 0) for k in range(500)]) for n in range(3)]
    for epoch in (0, 1, 2, 1):
        SN.remember(parts[epoch], epoch, path)
    history = parts[0].union(parts[1]).union(parts[2])
    words = sorted(map(tuple, SN.merged(spark.read.parquet(path)).collect()))
    assert words == sorted(map(tuple, SN.seen_words(history).collect()))
    assert SN.unseen(history, SN.merged(spark.read.parquet(path)), history).count() == 0


def test_false_hits_are_few_and_history_is_only_scanned(spark):
    history = table(spark, [("a", str(k), 0) for k in range(20_000)])
    new = table(spark, [("a", f"new{k}", 0) for k in range(5000)])
    path = scratch_path(spark, "history")
    history.write.parquet(path)
    history = spark.read.schema(SCHEMA).parquet(path)
    words = SN.merged(SN.seen_words(history))
    held = SN.unseen(new, words, history)
    assert held.count() == 5000
    # The look-up in the history: its side of the join is a scan, the few hits are broadcast.
    import re
    maybe = table(spark, [("a", "1", 0)]).select(*SN.KEYS)
    from pyspark.sql import functions as F
    plan = history.select(*SN.KEYS).join(F.broadcast(maybe), SN.KEYS, "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"Exchange hashpartitioning", plan)


def test_empty_sides(spark):
    none, some = table(spark, []), table(spark, [("a", "1", 1)])
    words = SN.merged(SN.seen_words(none))
    assert SN.unseen(some, words, none).count() == 1 and SN.unseen(none, words, some).count() == 0
