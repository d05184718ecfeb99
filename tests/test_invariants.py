"""Invariants from the survey's test strategy (§5)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from plume.operators import lake as LK
from plume.operators import silver as S
from plume.plans import catalog as C

from .conftest import SF_SMALL


def test_parts_sum_to_whole(spark):
    k = E.queries()["kpi_totals"](spark, SF_SMALL).first()
    assert k["twitter_posts"] + k["reddit_posts"] + k["bluesky_posts"] == k["total_posts"]
    share = E.queries()["source_share"](spark, SF_SMALL).agg(F.sum("share_pct")).first()[0]
    assert abs(share - 100.0) < 1e-6


def test_trend_score_identity(spark):
    # Q26: post_count · avg / 100 == total / 100 when no metric is NULL
    t = E.queries()["trending_windows"](spark, SF_SMALL)
    bad = t.where(F.abs(F.col("trend_score") - F.col("total_engagement") / 100.0) > 1e-3).count()
    assert bad == 0


def test_dedup_is_idempotent(spark):
    s = C.silver(spark, SF_SMALL)
    once = S.dedup_posts(s)
    assert once.count() == S.dedup_posts(once).count() == s.select("source", "post_id").distinct().count()


def test_upsert_twice_equals_once(spark):
    base, upd = C._versions(spark, SF_SMALL)
    keys = ["source", "post_id"]
    once = LK.upsert(base, upd, keys, "version")
    twice = LK.upsert(once, upd, keys, "version")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_compaction_keeps_rows(spark):
    rows = E.queries()["compact"](spark, SF_SMALL).agg(F.sum("rows")).first()[0]
    assert rows == C.topic(spark, SF_SMALL).count()


def test_related_docs_groups_copies(spark):
    # the test prose holds exact and near copies: some documents must share a bucket,
    # and every group id is the smallest id of its bucket members (never larger than the doc)
    r = E.queries()["related_docs"](spark, SF_SMALL)
    assert r.where("related").count() > 0
    assert r.where(F.col("group_id") > F.col("doc_id")).count() == 0
