"""The registered query catalog: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the provided tables (or data Spark derives from them) and
composes library operators; none collects. Clock-relative entries take the
fixed clock ``AS_OF`` so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.time import to_ntz
from ..operators import bronze as B
from ..functions import text as TF
from ..functions.time import age_bucket, parse_time
from ..operators import forecast as FC
from ..operators import kpis as K
from ..operators import lake as LK
from ..operators import models as MD
from ..operators import outliers as OUT
from ..operators import similarity as SIM
from ..operators import text as TX
from ..operators import ranking as R
from ..operators import related as REL
from ..operators import seen as SEEN
from ..operators import silver as S
from ..operators import topics as TOP
from ..operators import trends as TR
from ..operators import vector_index as VI
from ..operators import views as V
from ..session import Workspace, ensure_utc, exists, scratch_path
from ..sources import testbed
from ..sources import logs as LG
from ..streaming import bursts as BU
from ..streaming import medallion as MED
from ..streaming import runner as RUN
from ..sources import topic as TP
from .oracle import AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return testbed.topic_from_dir(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bronze(topic(spark, sf_dir), processed_at=F.col("topic_timestamp"))


def silver(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Deduplicated silver posts; name the columns a query needs so the
    dedup shuffle carries only those."""
    return S.silver_all(bronze(spark, sf_dir), columns=list(columns) or None)


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unified_posts(bronze(spark, sf_dir))


_STORED: dict[tuple[str, str], tuple[str, StructType]] = {}


#: Events that one task turns into posts: few bytes of a table are many bytes of envelopes.
PARSE_ROWS = 100_000


def dealt_out(table: DataFrame, rows: int = PARSE_ROWS) -> DataFrame:
    """The rows over enough tasks for costly work on each of them, however few row groups the table's files have."""
    return table.repartition(max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // rows)))


def stored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified posts, stored by (partition_date, source): parsed once a
    session and folder, then read through partition filters."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED or not exists(spark, _STORED[key][0]):
        path = scratch_path(spark, "unified")
        records = testbed.events_topic(dealt_out(events(spark, sf_dir)))
        rows = S.unified_posts(B.bronze(records, processed_at=F.col("topic_timestamp")))
        posts = rows.withColumn(V.DATE, F.to_date("created_ts"))
        MED.overwrite_touched(posts, path, [V.DATE, "source"])
        _STORED[key] = path, posts.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


PREVIOUS_REFRESH = "2024-01-30 00:00:00"
SINCE_CUTOFF = "2024-01-20 00:00:00"
UNIFIED_COLS = ["source", "post_id", "text", "author", "created_at", "engagement",
                "likes", "retweets", "hashtags", "subreddit"]
VIEW_COLS = ["source", "post_id", "author", "created_at", "engagement"]


# Topic and sentiment words that occur in the test posts (the AI vocabulary does not).
POST_TOPICS = ["update", "thread", "friends", "click", "view", "purchase"]
POST_POSITIVE, POST_NEGATIVE = ["up", "friends"], ["score"]


def topic_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver posts with their topics, from text and hashtags. Topics are matched before the dedup, which then carries a
    few words instead of the text."""
    posts = S.silver_all(bronze(spark, sf_dir), dedup=False,
                         columns=["created_at", "community", "text_clean", "hashtags", "engagement_score"])
    return S.dedup_posts(TX.with_topics(posts, POST_TOPICS).drop("text_clean", "hashtags"))


def _enriched(spark, sf_dir):
    posts = silver(spark, sf_dir, "created_at", "community", "text_clean", "hashtags", "engagement_score")
    return TX.enrich_posts(posts, POST_TOPICS, POST_POSITIVE, POST_NEGATIVE)


def q_silver_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir).select("source", "post_id", F.array_join("topics", ",").alias("topics"), "sentiment")


def q_silver_write(spark, sf_dir):
    """Enriched silver, stored by date and network, then read through its
    partitions. A write reads its posts twice, so they are stored first."""
    path, space = scratch_path(spark, "silver"), Workspace(spark, "enriched")
    posts = space.put(_enriched(spark, sf_dir))
    MED.write_silver(posts, 0, path)
    space.drop(posts)
    stored = spark.read.parquet(path).where("partition_date >= DATE '2024-01-15' AND source <> 'twitter'")
    return stored.groupBy("partition_date", "source").agg(
        F.count("*").alias("posts"), F.round(F.avg("sentiment"), 4).alias("avg_sentiment"))


def q_gold_incremental(spark, sf_dir):
    """Hourly statistics kept up to date over three waves of silver posts;
    every wave touches some hours of the waves before it. The posts are parsed
    and enriched once for all waves."""
    silver_path, gold_path, checkpoint = (scratch_path(spark, n) for n in ("silver", "gold", "ckpt"))
    space = Workspace(spark, "enriched")
    posts = space.put(_enriched(spark, sf_dir).withColumn("wave", F.crc32("post_id") % 3))
    for wave in range(3):
        MED.write_silver(posts.where(F.col("wave") == wave), wave, silver_path)
        RUN.drain(MED.incremental_gold(spark, silver_path, gold_path, checkpoint))
    space.drop(posts)
    return MED.read_gold(spark, gold_path)


def q_trending_windows(spark, sf_dir):
    return TR.trending_windows(silver(spark, sf_dir, "created_at", "engagement_score"))


def q_trending_top(spark, sf_dir):
    return TR.trending_top(TR.trending_windows(silver(spark, sf_dir, "created_at", "engagement_score")), 10)


def q_window_posts(spark, sf_dir):
    return TR.window_posts(silver(spark, sf_dir, "created_at"))


def q_hourly_stats(spark, sf_dir):
    posts = S.silver_all(bronze(spark, sf_dir), dedup=False, columns=["created_at", "community", "text_clean", "engagement_score"])
    scored = TX.sentiment(posts, "text_clean", POST_POSITIVE, POST_NEGATIVE).drop("text_clean", "positive", "negative", "label")
    return TR.hourly_stats(S.dedup_posts(scored), "sentiment")


def q_hourly_keywords(spark, sf_dir):
    return TR.hourly_keywords(topic_posts(spark, sf_dir))


def q_unified_posts(spark, sf_dir):
    return unified(spark, sf_dir).select(*UNIFIED_COLS)


def q_count_by_source(spark, sf_dir):
    return K.count_by_source(bronze(spark, sf_dir))


def q_source_share(spark, sf_dir):
    return K.source_share(unified(spark, sf_dir))


def q_kpi_totals(spark, sf_dir):
    return K.kpi_totals(unified(spark, sf_dir))


def q_new_since(spark, sf_dir):
    return K.new_since(unified(spark, sf_dir), PREVIOUS_REFRESH, ts="processed_at")


def q_distinct_sources(spark, sf_dir):
    return K.distinct_values(unified(spark, sf_dir), "source")


def q_distinct_communities(spark, sf_dir):
    return K.distinct_values(unified(spark, sf_dir), "subreddit")


def q_posts_by_day(spark, sf_dir):
    return V.posts_by_day(unified(spark, sf_dir), AS_OF)


def _view(df):
    return df.select(*VIEW_COLS)


def q_filter_source(spark, sf_dir):
    return _view(V.filter_source(stored_view(spark, sf_dir), "Reddit"))


def _period(name):
    def q(spark, sf_dir):
        return _view(V.filter_period(stored_view(spark, sf_dir), name, AS_OF))
    return q


def q_filter_last_hours(spark, sf_dir):
    return _view(V.filter_last_hours(stored_view(spark, sf_dir), 6, AS_OF))


def q_filter_community(spark, sf_dir):
    return _view(V.filter_communities(stored_view(spark, sf_dir), ["sub1", "sub4"]))


def q_recent_posts(spark, sf_dir):
    return _view(V.recent_posts(unified(spark, sf_dir), 50))


def q_hottest_posts(spark, sf_dir):
    return _view(V.hottest_posts(unified(spark, sf_dir), 50))


def q_post_links(spark, sf_dir):
    s = silver(spark, sf_dir, "author", "community")
    return s.select("source", "post_id", TF.permalink("source", "community", "author", "post_id").alias("link"))


def q_share_labels(spark, sf_dir):
    shares = K.source_share(unified(spark, sf_dir))
    return shares.select("source", TF.thousands("posts").alias("posts_label"), TF.percent1("share_pct").alias("share_label"))


def q_card_fields(spark, sf_dir):
    return V.card_fields(unified(spark, sf_dir), AS_OF)


def q_cap_per_community(spark, sf_dir):
    df = silver(spark, sf_dir).where(F.col("community").isNotNull())
    out = V.cap_per_group(df, "community", 5, [F.desc("created_at"), F.asc("post_id")])
    return out.select("community", "post_id", to_ntz("created_at").alias("created_at"))


def q_count_by_community(spark, sf_dir):
    return K.count_by(silver(spark, sf_dir).where(F.col("community").isNotNull()), "community")


def q_user_activity(spark, sf_dir):
    return K.user_activity(silver(spark, sf_dir, "author", "engagement_score", "created_at"))


def q_top_authors(spark, sf_dir):
    return K.top_authors(silver(spark, sf_dir, "author", "engagement_score"), 10)


def q_influencers(spark, sf_dir):
    return K.influencers(silver(spark, sf_dir, "author", "engagement_score"), 10)


def q_collection_tally(spark, sf_dir):
    return K.collection_tally(silver(spark, sf_dir, "community"))


def q_high_water_mark(spark, sf_dir):
    return K.high_water_mark(silver(spark, sf_dir))


def q_incremental_since(spark, sf_dir):
    posts = silver(spark, sf_dir, "created_at")
    prev = posts.where(F.col("created_at") < F.lit(SINCE_CUTOFF).cast("timestamp"))
    return K.incremental_since(posts, K.read_marks(prev)).select("source", "post_id")


def q_dedup_rate(spark, sf_dir):
    return K.dedup_rate(S.silver_all(bronze(spark, sf_dir), dedup=False), ("source", "post_id"))


def q_dedup_id(spark, sf_dir):
    return silver(spark, sf_dir, "topic_offset").select("source", "post_id", "topic_offset")


def q_hourly_volume_pivot(spark, sf_dir):
    return R.hourly_volume_pivot(silver(spark, sf_dir, "created_at"))


def _topic_hour(spark, sf_dir):
    return R.topic_hourly(topic_posts(spark, sf_dir))


def q_topic_hourly(spark, sf_dir):
    return _topic_hour(spark, sf_dir)


def q_topic_timeseries(spark, sf_dir):
    return R.topic_timeseries(_topic_hour(spark, sf_dir))


def q_topic_rank(spark, sf_dir):
    return R.topic_rank(_topic_hour(spark, sf_dir))


def q_top_posts_per_hour(spark, sf_dir):
    return R.top_posts_per_hour(topic_posts(spark, sf_dir), 3)


def q_burst_detect(spark, sf_dir):
    return R.burst_detect(silver(spark, sf_dir, "created_at"), 24, 2.0)


def q_topic_burst(spark, sf_dir):
    return R.topic_burst(R.topic_timeseries(_topic_hour(spark, sf_dir)))


def q_heat_score(spark, sf_dir):
    return R.heat_score(_topic_hour(spark, sf_dir), AS_OF, 24.0)


def q_period_change(spark, sf_dir):
    return R.period_change(silver(spark, sf_dir, "created_at"))


def q_weekly_report(spark, sf_dir):
    return R.weekly_report(silver(spark, sf_dir, "created_at", "engagement_score", "author"), "week")


# ---------------------------------------------------------------- text
# Terms that occur in the test prose (the AI vocabulary does not).
TOPIC_TERMS = ["that", "with", "from", "tion", "pour", "dans", "machine learning"]
FILTER_TERMS = ["tion", "ther", "sich"]
SEARCH_TERMS = ["rewh", "orre", "thatin"]


def docs(spark, sf_dir):
    ensure_utc(spark)
    return testbed.read_table(spark, sf_dir, "documents")


def q_keyword_topn(spark, sf_dir):
    return TX.keyword_topn(docs(spark, sf_dir), "text", 20)


def q_cloud_weights(spark, sf_dir):
    return TX.cloud_weights(docs(spark, sf_dir), "text", 100, 50)


def q_collocations(spark, sf_dir):
    return TX.collocations(docs(spark, sf_dir), "text", 50, 5)


def q_topic_mentions(spark, sf_dir):
    return TX.topic_mentions(docs(spark, sf_dir), TOPIC_TERMS)


def q_topic_top10(spark, sf_dir):
    counts = TX.topic_counts(TX.topic_mentions(docs(spark, sf_dir), TOPIC_TERMS))
    return counts.orderBy(F.desc("mentions"), F.asc("topic")).limit(10)


def q_keyword_filter(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.where(TX.matches_any(F.col("text"), FILTER_TERMS)).select("doc_id", "source")


def q_keyword_filter_lang(spark, sf_dir):
    d = docs(spark, sf_dir)
    cond = TX.matches_any(F.col("text"), FILTER_TERMS) & (F.col("lang") == "en") & ~F.col("text").startswith("RT @")
    return d.where(cond).select("doc_id", "source")


def q_sql_like_count(spark, sf_dir):
    docs(spark, sf_dir).createOrReplaceTempView("plume_documents")
    return spark.sql("SELECT source, count(*) AS docs FROM plume_documents "
                     "WHERE text LIKE '%tion%' GROUP BY source")


def q_filter_lang(spark, sf_dir):
    return docs(spark, sf_dir).where(F.col("lang").isin("en", "zh")).select("doc_id", "lang")


def q_sentiment(spark, sf_dir):
    return TX.sentiment(docs(spark, sf_dir)).select("doc_id", "positive", "negative", "sentiment", "label")


def q_detect_lang(spark, sf_dir):
    return TX.detect_language(docs(spark, sf_dir)).select("doc_id", "lang", "detected")


def q_extract_tags(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn(
        "tagged", F.concat(F.lit("#"), F.col("source"), F.lit(" #"), F.col("lang"), F.lit(" "), F.col("text")))
    t = TX.extract_tags(d, "tagged")
    return t.select("doc_id", F.array_join("hashtags", ",").alias("hashtags"),
                    F.array_join("mentions", ",").alias("mentions"))


def pages(spark, sf_dir):
    ensure_utc(spark)
    return testbed.read_table(spark, sf_dir, "pages")


def q_clean_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", TF.clean_html(F.col("html")).alias("text"))


def q_uri_tail(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", TF.uri_tail(F.col("url")).alias("tail"))


def q_search_union_dedup(spark, sf_dir):
    found = docs(spark, sf_dir).select("doc_id", TX.first_term(F.col("text"), SEARCH_TERMS).alias("term"))
    return found.where("term IS NOT NULL")


def q_semantic_topk(spark, sf_dir):
    ensure_utc(spark)
    return SIM.nearest_to_centroid(testbed.read_table(spark, sf_dir, "embeddings"), 5)


def _vector_queries(spark, sf_dir):
    """All vectors, and every hundredth of them as a query."""
    ensure_utc(spark)
    vectors = testbed.read_table(spark, sf_dir, "embeddings")
    return vectors, vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


def q_semantic_search(spark, sf_dir):
    return VI.search_exact(*_vector_queries(spark, sf_dir), 10)


def q_semantic_index(spark, sf_dir):
    vectors, queries = _vector_queries(spark, sf_dir)
    return VI.search_index(VI.build_index(vectors), vectors, queries, 10)


def q_hashtag_counts(spark, sf_dir):
    s = silver(spark, sf_dir)
    return (s.select(F.explode(F.transform("hashtags", lambda h: F.lower(h))).alias("hashtag"))
            .groupBy("hashtag").agg(F.count(F.lit(1)).alias("posts")))


def q_clean_text(spark, sf_dir):
    return silver(spark, sf_dir, "text_clean").select("source", "post_id", "text_clean")


def q_post_features(spark, sf_dir):
    d = TX.sentiment(docs(spark, sf_dir))
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                    F.size(TX.word_tokens(F.col("text"))).cast("bigint").alias("words"),
                    F.size(TX.matched_terms(F.col("text"), TOPIC_TERMS)).cast("bigint").alias("keyword_hits"),
                    "sentiment")


# -------------------------------------------------------------- sources
def q_scan_all(spark, sf_dir):
    parsed = B.parse_envelope(B.decode(topic(spark, sf_dir)))
    return parsed.select("topic_partition", "topic_offset", "source",
                         F.col("raw_data")["id"].alias("post_id"))


def q_scan_tail_n(spark, sf_dir):
    t = TP.tail(topic(spark, sf_dir), 50)
    return t.select("partition", "offset", F.col("key").cast("string").alias("key"))


def q_end_offset_total(spark, sf_dir):
    return TP.end_offsets(topic(spark, sf_dir))


REPLAY_POSITIONS = {0: 1000, 1: 2000}


def q_replay_from(spark, sf_dir):
    r = TP.replay_from(topic(spark, sf_dir), REPLAY_POSITIONS)
    return r.select("partition", "offset", F.col("key").cast("string").alias("key"))


def q_envelope_json(spark, sf_dir):
    v = topic(spark, sf_dir).select(F.col("value").cast("string").alias("j"))
    return v.select(F.get_json_object("j", "$.source").alias("source"),
                    F.get_json_object("j", "$.data.id").alias("post_id"),
                    F.get_json_object("j", "$.timestamp").alias("sent_at"),
                    F.get_json_object("j", "$.data.metrics.likes").cast("bigint").alias("likes"))


def corrupted_topic(spark, sf_dir):
    """The topic with a second producer that sends whole document texts
    instead of envelopes."""
    prose = docs(spark, sf_dir).select(
        F.col("doc_id").cast("string").cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
        F.lit(testbed.TOPIC).alias("topic"), (F.col("doc_id") % 3).cast("int").alias("partition"),
        (F.col("doc_id") + 2 * testbed.REDELIVERY_OFFSET).alias("offset"),
        F.lit(AS_OF).cast("timestamp").alias("timestamp"))
    return topic(spark, sf_dir).unionByName(prose)


def q_quarantine(spark, sf_dir):
    q = B.split_bad(corrupted_topic(spark, sf_dir))
    return q.select("payload", "error", "topic_partition", "topic_offset")


def q_parse_yield(spark, sf_dir):
    return K.parse_yield(B.parse_envelope(B.decode(corrupted_topic(spark, sf_dir))))


def q_json_nested(spark, sf_dir):
    b = bronze(spark, sf_dir)
    m = F.col("raw_data")["metrics"]
    return b.select("source", F.col("raw_data")["id"].alias("post_id"),
                    F.from_json(m, "likes bigint, score bigint")["likes"].alias("likes"),
                    F.get_json_object(m, "$.score").cast("bigint").alias("score"))


def q_array_ops(spark, sf_dir):
    s = silver(spark, sf_dir)
    objects = F.transform("hashtags", lambda h: F.struct(h.alias("tag")))      # entity objects
    return s.select("source", "post_id", "num_hashtags", "num_mentions",
                    F.array_join("hashtags", ",").alias("tags"),
                    F.array_join(F.transform(objects, lambda o: o["tag"]), ",").alias("tag_objects"),
                    F.coalesce(F.get(F.col("hashtags"), 0), F.lit("none")).alias("first_tag"))


def events(spark, sf_dir):
    ensure_utc(spark)
    return testbed.read_table(spark, sf_dir, "events")


def q_parse_time(spark, sf_dir):
    e = events(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    kind = F.col("event_id") % 4
    s = (F.when(kind == 0, F.concat(F.date_format(ts, fmt), F.lit("Z")))
         .when(kind == 1, F.concat(F.date_format(ts + F.expr("INTERVAL 8 HOURS"), fmt), F.lit("+08:00")))
         .when(kind == 2, F.date_format(ts, fmt))
         .otherwise(F.unix_seconds(ts).cast("string")))
    return e.select("event_id", to_ntz(parse_time(s)).alias("parsed"))


def q_format_time(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.select("event_id", F.date_format("ts", "HH:mm:ss").alias("hms"),
                    F.date_format("ts", "yyyy-MM-dd").alias("ymd"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


def q_age_bucket(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.select("event_id", age_bucket(F.col("ts").cast("timestamp"), AS_OF).alias("age"))


def q_engagement_scores(spark, sf_dir):
    return silver(spark, sf_dir, "engagement_score", "engagement").select("source", "post_id", "engagement_score", "engagement")


# ---------------------------------------------------------------- joins
def q_enrich_author(spark, sf_dir):
    ensure_utc(spark)
    o = testbed.read_table(spark, sf_dir, "orders")
    c = testbed.read_table(spark, sf_dir, "customer")
    users = c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("author_name"),
                     (F.col("c_mktsegment") == "BUILDING").alias("_v"))
    # No broadcast hint: the user table grows with the data; AQE broadcasts it
    # only when its measured size is under the threshold.
    out = o.select("o_orderkey", "o_custkey").join(users, "o_custkey", "left")
    return out.select("o_orderkey", "o_custkey", "author_name",
                      F.coalesce("_v", F.lit(False)).alias("verified"))


SEEN_BEFORE = "2024-01-20 00:00:00"
BATCH_FROM = "2024-01-15 00:00:00"


def q_new_only_anti(spark, sf_dir):
    s = silver(spark, sf_dir, "created_at")
    seen = s.where(F.col("created_at") < F.lit(SEEN_BEFORE).cast("timestamp")).select("source", "post_id")
    batch = s.where(F.col("created_at") >= F.lit(BATCH_FROM).cast("timestamp"))
    return batch.join(seen, ["source", "post_id"], "left_anti").select("source", "post_id")


def q_new_only_filtered(spark, sf_dir):
    """As new_only_anti, through bits of the seen posts; two epochs, the first one written twice."""
    path = scratch_path(spark, "seen")
    s = silver(spark, sf_dir, "created_at")
    seen = s.where(F.col("created_at") < F.lit(SEEN_BEFORE).cast("timestamp")).select("source", "post_id")
    for epoch in (0, 1, 0):
        SEEN.remember(seen.where(F.crc32("post_id") % 2 == epoch), epoch, path)
    batch = s.where(F.col("created_at") >= F.lit(BATCH_FROM).cast("timestamp"))
    return SEEN.unseen(batch, SEEN.merged(spark.read.parquet(path)), seen).select("source", "post_id")


def q_seen_history_cap(spark, sf_dir):
    s = silver(spark, sf_dir, "created_at")
    out = V.history_cap(s, "source", [F.desc("created_at"), F.asc("post_id")])
    return out.select("source", "post_id")


def _versions(spark, sf_dir):
    s = silver(spark, sf_dir, "created_at", "engagement_score", "processed_at")
    base = (s.where(F.col("created_at") < F.lit(SEEN_BEFORE).cast("timestamp"))
            .select("source", "post_id", "engagement_score", F.col("processed_at").alias("version")))
    upd = (s.where(F.col("created_at") >= F.lit(BATCH_FROM).cast("timestamp"))
           .select("source", "post_id", (F.col("engagement_score") + 100).alias("engagement_score"),
                   (F.col("processed_at") + F.expr("INTERVAL 1 DAY")).alias("version")))
    return base, upd


def q_upsert_latest(spark, sf_dir):
    base, upd = _versions(spark, sf_dir)
    out = LK.upsert(base, upd, ["source", "post_id"], "version")
    return out.select("source", "post_id", "engagement_score", to_ntz("version").alias("version"))


AS_OF_READ = "2024-01-25 00:00:00"


def q_as_of_read(spark, sf_dir):
    base, upd = _versions(spark, sf_dir)
    out = LK.as_of(base.unionByName(upd), ["source", "post_id"], "version", AS_OF_READ)
    return out.select("source", "post_id", "engagement_score")


# ----------------------------------------------------------------- lake
def _bronze_table(spark, sf_dir, name):
    path = scratch_path(spark, name)
    LK.write_partitioned(bronze(spark, sf_dir), path, ["partition_date", "source"], mode="overwrite")
    return path


def _partition_counts(df):
    return df.groupBy("partition_date", "source").agg(F.count(F.lit(1)).alias("rows"))


def q_bronze_scan(spark, sf_dir):
    path = _bronze_table(spark, sf_dir, "bronze")
    return _partition_counts(spark.read.parquet(path))


def q_partition_read(spark, sf_dir):
    path = _bronze_table(spark, sf_dir, "bronze")
    t = spark.read.parquet(path).where((F.col("partition_date") == F.lit("2024-01-15").cast("date"))
                                       & (F.col("source") == "reddit"))
    return t.select(F.col("raw_data")["id"].alias("post_id"), "topic_offset")


def q_retention_keep(spark, sf_dir):
    path = _bronze_table(spark, sf_dir, "bronze")
    return _partition_counts(LK.retention_keep(spark.read.parquet(path), AS_OF, 7))


def q_delete_where(spark, sf_dir):
    path = _bronze_table(spark, sf_dir, "bronze")
    LK.delete_where(spark, path, "source = 'reddit' AND partition_date < DATE'2024-01-10'",
                    ["partition_date", "source"], scratch_path(spark, "delete-staging"))
    return _partition_counts(spark.read.parquet(path))


def q_compact(spark, sf_dir):
    path = scratch_path(spark, "bronze-small")
    # many small files on purpose: one file per (task, partition)
    bronze(spark, sf_dir).repartition(16).write.partitionBy("partition_date", "source").parquet(path)
    LK.compact(spark, path, ["partition_date", "source"], scratch_path(spark, "compact-staging"))
    return _partition_counts(spark.read.parquet(path))


def q_zorder(spark, sf_dir):
    src, out = scratch_path(spark, "silver-table"), scratch_path(spark, "silver-zordered")
    (silver(spark, sf_dir, "created_at", "engagement_score")
     .select("source", "post_id", "created_at", "engagement_score").write.parquet(src))
    table = spark.read.parquet(src).withColumn("_id", F.col("post_id").cast("bigint")) \
        .withColumn("_t", F.unix_seconds("created_at"))
    LK.zorder(table, ["_id", "_t"], 8).drop("_id", "_t", "_zkey").write.parquet(out)
    return spark.read.parquet(out).select("source", "post_id", "engagement_score")


def q_merge_schema(spark, sf_dir):
    path = scratch_path(spark, "merged")
    s = silver(spark, sf_dir)
    s.where(F.col("source") != "reddit").select("source", "post_id", "language") \
        .write.parquet(f"{path}/part=a")
    s.where(F.col("source") == "reddit").select("source", "post_id", "community") \
        .write.parquet(f"{path}/part=b")
    m = LK.read_merged(spark, path)
    return m.groupBy("source").agg(F.count(F.lit(1)).alias("rows"),
                                   F.count("language").alias("with_language"),
                                   F.count("community").alias("with_community"))


# --------------------------------------------------------------- models
def q_forecast_volume(spark, sf_dir):
    return MD.forecast_volume(silver(spark, sf_dir, "created_at"), AS_OF, 30, 168)


def q_forecast_trend(spark, sf_dir):
    return FC.forecast_trend(silver(spark, sf_dir, "created_at"), AS_OF, 30, 168)


def q_forecast_design(spark, sf_dir):
    return FC.forecast_design(silver(spark, sf_dir, "created_at"), AS_OF, 30, 168)


def q_anomaly_flag(spark, sf_dir):
    return MD.anomaly_flag(silver(spark, sf_dir, "created_at"), AS_OF, 30, 3.5)


def _feature_posts(spark, sf_dir):
    return silver(spark, sf_dir, "created_at", "text_clean", "hashtags", "engagement_score")


def q_silver_features(spark, sf_dir):
    return OUT.post_features(_feature_posts(spark, sf_dir), AS_OF, POST_TOPICS, POST_POSITIVE, POST_NEGATIVE)


def q_unusual_posts(spark, sf_dir):
    return OUT.unusual_posts(_feature_posts(spark, sf_dir), AS_OF, POST_TOPICS, POST_POSITIVE, POST_NEGATIVE)


def q_dq_checks(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return MD.dq_checks(b, S.silver_all(b, dedup=False), AS_OF)


# ----------------------------------------------------------------- logs
def log_lines(spark, sf_dir):
    """Collector log lines derived from ``events``: posts are success lines,
    ``error`` events failures, ``signup`` events rate-limit notices; the
    writing collector is picked by user."""
    e = events(spark, sf_dir)
    who = F.col("user_id") % 3
    file = F.concat(F.when(who == 0, "twitter").when(who == 1, "reddit").otherwise("bluesky"),
                    F.lit("_collector.log"))
    eid = F.col("event_id").cast("string")
    msg = (F.when(F.col("event_type") == "error", F.concat(F.lit("❌ Error: connection failed for request "), eid))
           .when(F.col("event_type") == "signup", F.lit("Rate limit reached (429), sleeping"))
           .otherwise(F.concat(F.lit("Collected and sent post "), eid)))
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), msg)
    return e.select(file.alias("file"), F.col("ts").cast("timestamp").alias("ts"), line.alias("line"))


def q_log_tail(spark, sf_dir):
    t = LG.log_tail(log_lines(spark, sf_dir), 10, AS_OF)
    return t.select("file", to_ntz("ts").alias("ts"), "line", "pos")


def q_collector_health(spark, sf_dir):
    h = LG.collector_health(log_lines(spark, sf_dir), AS_OF, 20, 300)
    return h.select("file", "rate_limited", "last_success", "has_error",
                    to_ntz("last_line_at").alias("last_line_at"), "status")


# ------------------------------------------------------------ streaming
FILES_PER_SLICE = 2


class Landed(NamedTuple):
    """A topic stored as files, so many of them in each time slice."""
    path: str
    files: int


def _landed(records: DataFrame, name: str, first: int | None = None) -> Landed:
    """Land the topic, or its first slices only."""
    at = Landed(scratch_path(records.sparkSession, name), testbed.files_per_slice(records, 10, FILES_PER_SLICE))
    testbed.write_topic_slices(records, at.path, 10, at.files, first=first)
    return at


def _landed_topic(spark, sf_dir, name, first=None):
    return _landed(topic(spark, sf_dir), name, first)


def _topic_stream(spark, landed):
    return TP.read_topic_files(spark, landed.path, streaming=True, max_files_per_trigger=landed.files)


def _bronze_stream(spark, landed):
    return RUN.bronze_stream(_topic_stream(spark, landed), processed_at=F.col("topic_timestamp"))


def q_stream_envelope(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files")
    out = scratch_path(spark, "stream-bronze")
    RUN.drain(RUN.start(_bronze_stream(spark, src), scratch_path(spark, "ckpt"), "parquet", out))
    b = RUN.read_sink(spark, out)
    return b.select("source", F.col("raw_data")["id"].alias("post_id"), "topic_offset")


def q_bronze_roundtrip(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files")
    out = scratch_path(spark, "stream-bronze")
    RUN.drain(RUN.start(_bronze_stream(spark, src), scratch_path(spark, "ckpt"), "parquet", out,
                        partition_by=["partition_date", "source"]))
    return _partition_counts(RUN.read_sink(spark, out))


def q_stream_restart(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files", first=1)
    out, ckpt = scratch_path(spark, "stream-bronze"), scratch_path(spark, "ckpt")

    def run():
        RUN.drain(RUN.start(_bronze_stream(spark, src), ckpt, "parquet", out,
                            partition_by=["partition_date", "source"]))
    run()
    testbed.write_topic_slices(topic(spark, sf_dir), src.path, 10, src.files, skip=1)
    run()   # restart from the checkpoint: only the new files are read
    run()   # nothing new: adds no rows
    return _partition_counts(RUN.read_sink(spark, out))


def q_stream_count_by_source(spark, sf_dir):
    import uuid

    src = _landed_topic(spark, sf_dir, "topic-files")
    name = f"plume_counts_{uuid.uuid4().hex[:8]}"
    agg = K.count_by_source(_bronze_stream(spark, src))
    RUN.drain(RUN.start(agg, scratch_path(spark, "ckpt"), "memory", mode="complete", query_name=name))
    return spark.table(name)


def q_sql_stream(spark, sf_dir):
    import uuid

    src = _landed_topic(spark, sf_dir, "topic-files")
    view, name = f"plume_bronze_{uuid.uuid4().hex[:8]}", f"plume_sql_{uuid.uuid4().hex[:8]}"
    _bronze_stream(spark, src).createOrReplaceTempView(view)
    agg = spark.sql(f"SELECT source, count(*) AS post_count FROM {view} "
                    f"WHERE raw_data['text'] LIKE '%from @user1%' GROUP BY source")
    RUN.drain(RUN.start(agg, scratch_path(spark, "ckpt"), "memory", mode="complete", query_name=name))
    return spark.table(name)


def q_stream_dedup(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files")
    out = scratch_path(spark, "stream-silver")
    sil = RUN.silver_stream(_bronze_stream(spark, src))
    RUN.drain(RUN.start(sil, scratch_path(spark, "ckpt"), "parquet", out))
    return RUN.read_sink(spark, out).select("source", "post_id")


def q_stream_trending(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files")
    out = scratch_path(spark, "stream-gold")
    gold = RUN.trending_stream(RUN.silver_stream(_bronze_stream(spark, src)))
    RUN.drain(RUN.start(gold, scratch_path(spark, "ckpt"), "parquet", out))
    return RUN.read_sink(spark, out)


def q_burst_alerts(spark, sf_dir):
    return BU.burst_alerts(topic_posts(spark, sf_dir), 1.5, 8)


def q_stream_burst_alerts(spark, sf_dir):
    src, out = _landed_topic(spark, sf_dir, "topic-files"), scratch_path(spark, "alerts")
    posts = TX.with_topics(RUN.silver_stream(_bronze_stream(spark, src)), POST_TOPICS)
    with BU.keyed_state(spark):
        q = RUN.start(BU.burst_alert_stream(posts, 1.5, 8), scratch_path(spark, "ckpt"), "parquet", out)
    RUN.drain(q)
    return RUN.read_sink(spark, out)


def q_stream_parse_yield(spark, sf_dir):
    """parse_yield, counted by the stream itself while it lands bronze."""
    src, out = _landed(corrupted_topic(spark, sf_dir), "topic-files"), scratch_path(spark, "stream-bronze")
    rows = RUN.bronze_stream(_topic_stream(spark, src), processed_at=F.col("topic_timestamp"), observe="intake")
    q = RUN.start(rows, scratch_path(spark, "ckpt"), "parquet", out)
    RUN.drain(q)
    batches = RUN.intake(q)
    counts = spark.createDataFrame([tuple(sum(b[c] for b in batches) for c in ("records", "parsed", "known_source"))],
                                   "records bigint, parsed bigint, known_source bigint")
    return counts.withColumn("parse_rate", F.round(F.try_divide(F.col("parsed"), F.col("records")), 4))


def q_stream_fanout(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files")
    bronze_out, counts_out = scratch_path(spark, "fan-bronze"), scratch_path(spark, "fan-counts")

    def both(batch, epoch_id):
        batch.persist()
        try:   # per-epoch folders make a replayed epoch overwrite itself (idempotent)
            batch.write.mode("overwrite").parquet(f"{bronze_out}/epoch={epoch_id}")
            RUN.counts_by_source_batch(batch).write.mode("overwrite").parquet(f"{counts_out}/epoch={epoch_id}")
        finally:
            batch.unpersist()
    RUN.drain(RUN.start_foreach_batch(_bronze_stream(spark, src), scratch_path(spark, "ckpt"), both))
    counts = RUN.read_sink(spark, counts_out)
    return counts.groupBy("source").agg(F.sum("post_count").alias("post_count"))


def q_medallion_e2e(spark, sf_dir):
    src = _landed_topic(spark, sf_dir, "topic-files")
    bronze_out, silver_out = scratch_path(spark, "m-bronze"), scratch_path(spark, "m-silver")
    RUN.drain(RUN.start(_bronze_stream(spark, src), scratch_path(spark, "ckpt"), "parquet", bronze_out,
                        partition_by=["partition_date", "source"]))
    schema = spark.read.parquet(bronze_out).schema
    bronze_files = spark.readStream.schema(schema).parquet(bronze_out)
    RUN.drain(RUN.start(RUN.silver_stream(bronze_files), scratch_path(spark, "ckpt"), "parquet", silver_out))
    return TR.trending_windows(RUN.read_sink(spark, silver_out))


# -------------------------------------------------- per-network silver
SILVER_COLS = ["source", "post_id", "author", "created_at", "language", "community", "likes", "shares",
               "replies", "quotes", "engagement_score", "num_hashtags", "num_mentions", "topic_offset"]


def _net(fn):
    def q(spark, sf_dir):
        out = fn(bronze(spark, sf_dir))
        return out.withColumn("created_at", to_ntz("created_at")).select(*SILVER_COLS)
    return q


def q_sql_functions(spark, sf_dir):
    from ..functions import sql as SQLF

    SQLF.register(spark)
    docs(spark, sf_dir).createOrReplaceTempView("plume_documents")
    p = pages(spark, sf_dir)
    p.createOrReplaceTempView("plume_pages")
    d = spark.sql("SELECT doc_id AS id, 'doc' AS kind, plume_detect_language(text) AS detected, "
                  "plume_sentiment_score(text) AS sentiment, CAST(size(plume_extract_keywords(text)) AS BIGINT) AS keywords, "
                  "CAST(NULL AS STRING) AS clean FROM plume_documents")
    h = spark.sql("SELECT page_id AS id, 'page' AS kind, CAST(NULL AS STRING) AS detected, "
                  "CAST(NULL AS DOUBLE) AS sentiment, CAST(NULL AS BIGINT) AS keywords, "
                  "plume_clean_html(html) AS clean FROM plume_pages")
    return d.unionByName(h)


def q_sql_phrases(spark, sf_dir):
    """X2 as a SQL user calls it: how many phrases a document has, and how many different ones."""
    from ..functions import sql as SQLF

    SQLF.register(spark)
    docs(spark, sf_dir).createOrReplaceTempView("plume_documents")
    return spark.sql("SELECT doc_id, CAST(size(p) AS BIGINT) AS phrases, CAST(size(array_distinct(p)) AS BIGINT) AS distinct_phrases "
                     "FROM (SELECT doc_id, plume_extract_phrases(text) AS p FROM plume_documents)")


def q_latest_feed(spark, sf_dir):
    return _view(V.recent_posts(unified(spark, sf_dir), 20))


def q_lda_topics(spark, sf_dir):
    return TOP.top_terms(TOP.fit_topics(docs(spark, sf_dir), k=5, rounds=10), 8)


def q_term_mentions(spark, sf_dir):
    """The vocabulary: every pair and triple of neighbouring words of the benchmark items."""
    ensure_utc(spark)
    words = testbed.read_table(spark, sf_dir, "benchmark").select(TX.word_tokens("text").alias("t"))
    shifted = words.select(*[F.slice("t", i + 1, F.greatest(F.size("t"), F.lit(1))).alias(f"t{i}") for i in range(3)])
    z = shifted.select(F.explode(F.arrays_zip("t0", "t1", "t2")).alias("z"))
    grams = F.array(*[F.when(F.col(f"z.t{n - 1}").isNotNull(), F.concat_ws(" ", *[f"z.t{i}" for i in range(n)])) for n in (2, 3)])
    return TOP.term_mentions(docs(spark, sf_dir), z.select(F.explode(grams).alias("term")).where("term IS NOT NULL"), (2, 3))


def q_related_docs(spark, sf_dir):
    return TX.related_groups(docs(spark, sf_dir), "doc_id", "text")


def q_related_classes(spark, sf_dir):
    return REL.related_classes(docs(spark, sf_dir), "doc_id", "text")


def queries() -> dict[str, Query]:
    return {
        "trending_windows": q_trending_windows,
        "trending_top": q_trending_top,
        "window_posts": q_window_posts,
        "silver_enriched": q_silver_enriched,
        "silver_write": q_silver_write,
        "hourly_stats": q_hourly_stats,
        "gold_incremental": q_gold_incremental,
        "hourly_keywords": q_hourly_keywords,
        "unified_posts": q_unified_posts,
        "count_by_source": q_count_by_source,
        "source_share": q_source_share,
        "kpi_totals": q_kpi_totals,
        "new_since": q_new_since,
        "distinct_sources": q_distinct_sources,
        "distinct_communities": q_distinct_communities,
        "posts_by_day": q_posts_by_day,
        "filter_source": q_filter_source,
        "filter_today": _period("today"),
        "filter_yesterday": _period("yesterday"),
        "filter_week": _period("week"),
        "filter_month": _period("month"),
        "filter_last_hours": q_filter_last_hours,
        "filter_community": q_filter_community,
        "recent_posts": q_recent_posts,
        "hottest_posts": q_hottest_posts,
        "card_fields": q_card_fields,
        "post_links": q_post_links,
        "share_labels": q_share_labels,
        "cap_per_community": q_cap_per_community,
        "count_by_community": q_count_by_community,
        "user_activity": q_user_activity,
        "top_authors": q_top_authors,
        "influencers": q_influencers,
        "collection_tally": q_collection_tally,
        "high_water_mark": q_high_water_mark,
        "incremental_since": q_incremental_since,
        "dedup_rate": q_dedup_rate,
        "dedup_id": q_dedup_id,
        "hourly_volume_pivot": q_hourly_volume_pivot,
        "topic_hourly": q_topic_hourly,
        "topic_timeseries": q_topic_timeseries,
        "topic_rank": q_topic_rank,
        "top_posts_per_hour": q_top_posts_per_hour,
        "burst_detect": q_burst_detect,
        "heat_score": q_heat_score,
        "topic_burst": q_topic_burst,
        "period_change": q_period_change,
        "weekly_report": q_weekly_report,
        "keyword_topn": q_keyword_topn,
        "cloud_weights": q_cloud_weights,
        "collocations": q_collocations,
        "topic_mentions": q_topic_mentions,
        "topic_top10": q_topic_top10,
        "keyword_filter": q_keyword_filter,
        "keyword_filter_lang": q_keyword_filter_lang,
        "sql_like_count": q_sql_like_count,
        "filter_lang": q_filter_lang,
        "sentiment": q_sentiment,
        "detect_lang": q_detect_lang,
        "extract_tags": q_extract_tags,
        "clean_html": q_clean_html,
        "uri_tail": q_uri_tail,
        "search_union_dedup": q_search_union_dedup,
        "semantic_topk": q_semantic_topk,
        "semantic_search": q_semantic_search,
        "semantic_index": q_semantic_index,
        "hashtag_counts": q_hashtag_counts,
        "clean_text": q_clean_text,
        "post_features": q_post_features,
        "scan_all": q_scan_all,
        "scan_tail_n": q_scan_tail_n,
        "end_offset_total": q_end_offset_total,
        "replay_from": q_replay_from,
        "envelope_json": q_envelope_json,
        "quarantine": q_quarantine,
        "parse_yield": q_parse_yield,
        "json_nested": q_json_nested,
        "array_ops": q_array_ops,
        "parse_time": q_parse_time,
        "format_time": q_format_time,
        "age_bucket": q_age_bucket,
        "engagement_scores": q_engagement_scores,
        "enrich_author": q_enrich_author,
        "new_only_anti": q_new_only_anti,
        "new_only_filtered": q_new_only_filtered,
        "seen_history_cap": q_seen_history_cap,
        "upsert_latest": q_upsert_latest,
        "as_of_read": q_as_of_read,
        "bronze_scan": q_bronze_scan,
        "partition_read": q_partition_read,
        "retention_keep": q_retention_keep,
        "delete_where": q_delete_where,
        "compact": q_compact,
        "zorder": q_zorder,
        "merge_schema": q_merge_schema,
        "forecast_volume": q_forecast_volume,
        "forecast_trend": q_forecast_trend,
        "forecast_design": q_forecast_design,
        "anomaly_flag": q_anomaly_flag,
        "silver_features": q_silver_features,
        "unusual_posts": q_unusual_posts,
        "dq_checks": q_dq_checks,
        "log_tail": q_log_tail,
        "collector_health": q_collector_health,
        "stream_envelope": q_stream_envelope,
        "bronze_roundtrip": q_bronze_roundtrip,
        "stream_restart": q_stream_restart,
        "stream_count_by_source": q_stream_count_by_source,
        "sql_stream": q_sql_stream,
        "stream_dedup": q_stream_dedup,
        "stream_trending": q_stream_trending,
        "stream_parse_yield": q_stream_parse_yield,
        "stream_fanout": q_stream_fanout,
        "burst_alerts": q_burst_alerts,
        "stream_burst_alerts": q_stream_burst_alerts,
        "medallion_e2e": q_medallion_e2e,
        "silver_twitter": _net(S.silver_twitter),
        "silver_reddit": _net(S.silver_reddit),
        "silver_bluesky": _net(S.silver_bluesky),
        "latest_feed": q_latest_feed,
        "sql_functions": q_sql_functions,
        "sql_phrases": q_sql_phrases,
        "lda_topics": q_lda_topics,
        "term_mentions": q_term_mentions,
        "related_docs": q_related_docs,
        "related_classes": q_related_classes,
    }


FLAGSHIP = "trending_windows"
