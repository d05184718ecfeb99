"""DuckDB SQL for every registered query (the correctness oracle).

The shared CTEs re-derive the post data model from ``events`` with the same
column arithmetic as ``plume.sources.testbed`` – without the JSON round
trip, so the envelope/bronze parse path is itself under test.
"""

from __future__ import annotations

from ..operators import forecast as FC
from ..operators import outliers as OUT
from ..operators import related as REL
from ..operators import topics as TOP

# Fixed values shared with the Spark side (see plume.plans.catalog).
AS_OF = "2024-01-30 12:00:00"

REC = """
rec AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id,
         CASE event_type WHEN 'click' THEN 'twitter' WHEN 'view' THEN 'reddit'
              WHEN 'purchase' THEN 'bluesky' ELSE event_type END AS source,
         event_id, user_id, event_type, ts, copy,
         CAST(event_id % 3 AS INTEGER) AS topic_partition,
         CAST(event_id // 3 + copy * 1000000000000 AS BIGINT) AS topic_offset,
         ts + copy * INTERVAL 1 HOUR AS topic_ts,
         CAST(floor(value) AS BIGINT) AS a,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(user_id % 10 AS BIGINT) AS c,
         CAST(event_id % 5 AS BIGINT) AS d,
         'user' || CAST(user_id AS VARCHAR) AS uname,
         'sub' || CAST(user_id % 9 AS VARCHAR) AS sub,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
         CASE WHEN user_id % 7 = 0 THEN 'fr' WHEN user_id % 11 = 0 THEN 'zh' ELSE 'en' END AS tw_lang
  FROM (SELECT *, unnest(CASE WHEN minute(ts) < 3 THEN [0, 1] ELSE [0] END) AS copy FROM events)
)"""

# Silver: typed posts of the three networks, before dedup.
SILVER_RAW = REC + """,
silver_raw AS (
  SELECT source, post_id, ts AS created_at, topic_partition, topic_offset, topic_ts,
         user_id, event_type,
         CASE source WHEN 'twitter' THEN uname WHEN 'reddit' THEN uname
              ELSE uname || '.bsky.social' END AS author,
         CASE source WHEN 'reddit' THEN sub END AS community,
         CASE source WHEN 'twitter' THEN tw_lang ELSE 'en' END AS language,
         a AS likes,
         CASE WHEN source = 'reddit' THEN NULL ELSE k END AS shares,
         CASE WHEN source = 'reddit' THEN k ELSE c END AS replies,
         CASE WHEN source = 'reddit' THEN NULL ELSE d END AS quotes,
         CASE WHEN source = 'reddit' THEN a + 2 * k ELSE 2 * a + 5 * k + 3 * c + 4 * d END AS engagement_score,
         CASE WHEN source = 'reddit' THEN a ELSE a + 2 * k END AS engagement,
         CASE WHEN source = 'reddit' THEN [] ELSE [event_type] END AS hashtags
  FROM rec
  WHERE source IN ('twitter', 'reddit', 'bluesky')
    AND NOT (source = 'twitter' AND tw_lang NOT IN ('en', 'zh'))
)"""

SILVER = SILVER_RAW + """,
silver AS (
  SELECT * FROM silver_raw
  QUALIFY row_number() OVER (PARTITION BY source, post_id ORDER BY topic_offset, topic_partition) = 1
)"""


# Entity decoding order used by the Spark side (&amp; last).
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
             ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "\u00b7"), ("&copy;", "\u00a9"),
             ("&reg;", "\u00ae"), ("&hellip;", "\u2026"), ("&mdash;", "\u2014"),
             ("&ndash;", "\u2013"), ("&amp;", "&")]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unescape_sql(x: str) -> str:
    for ent, ch in _ENTITIES:
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
    return x


def collapse_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


def clean_html_sql(x: str) -> str:
    return collapse_sql(f"regexp_replace({unescape_sql(x)}, '<[^>]+>', '', 'g')")


def clean_plain_sql(x: str) -> str:
    return collapse_sql(unescape_sql(x))


UNIFIED = REC + f""",
unified AS (
  SELECT CASE source WHEN 'twitter' THEN 'Twitter' WHEN 'reddit' THEN 'Reddit' ELSE 'Bluesky' END AS source,
    post_id,
    CASE source
      WHEN 'twitter' THEN 'Update ' || post_id || ' from @' || uname || ': #' || event_type
                          || ' is up, see http://t.co/p' || post_id || ' and www.ex.com/' || CAST(user_id AS VARCHAR)
      WHEN 'reddit' THEN {clean_html_sql("'Thread ' || post_id || ' &amp; ' || event_type")} || ' ' ||
                         {clean_html_sql("'<p>Score ' || CAST(a AS VARCHAR) || '</p>  for &lt;i&gt;' || sub || ' http://r.co/' || post_id")}
      ELSE {clean_plain_sql("'Note ' || post_id || ' #' || event_type || ' with @' || uname || '.bsky.social  &amp;  friends'")}
    END AS text,
    CASE source WHEN 'bluesky' THEN uname || '.bsky.social' ELSE uname END AS author,
    CASE source WHEN 'twitter' THEN iso || '+00:00' WHEN 'reddit' THEN iso ELSE iso || 'Z' END AS created_at,
    CASE source WHEN 'reddit' THEN a ELSE a + 2 * k END AS engagement,
    a AS likes,
    CASE source WHEN 'reddit' THEN 0 ELSE k END AS retweets,
    CASE source WHEN 'reddit' THEN '' ELSE event_type END AS hashtags,
    CASE source WHEN 'reddit' THEN sub END AS subreddit,
    ts AS created_ts, topic_ts AS processed_at, topic_partition, topic_offset
  FROM rec WHERE source IN ('twitter', 'reddit', 'bluesky')
)"""


def with_silver(body: str) -> str:
    return "WITH " + SILVER + "\n" + body


def with_unified(body: str) -> str:
    return "WITH " + UNIFIED + "\n" + body


def with_rec(body: str) -> str:
    return "WITH " + REC + "\n" + body


_AS_OF = f"TIMESTAMP '{AS_OF}'"
_VIEW = "SELECT source, post_id, author, created_at, engagement FROM unified"


def _day_label(d: str) -> str:
    n = f"greatest(date_diff('day', {d}, CAST({_AS_OF} AS DATE)), 0)"
    return (f"CASE WHEN {d} IS NULL THEN NULL WHEN {n} = 0 THEN 'today' WHEN {n} = 1 THEN 'yesterday' "
            f"WHEN {n} <= 7 THEN printf('%d days ago', {n}) ELSE strftime({d}, '%Y-%m-%d') END")


def _age_bucket(ts: str) -> str:
    secs = f"greatest(CAST(floor(epoch({_AS_OF})) AS BIGINT) - CAST(floor(epoch({ts})) AS BIGINT), 0)"
    days = f"({secs} // 86400)"
    rem = f"({secs} - {days} * 86400)"
    return (f"CASE WHEN {ts} IS NULL THEN NULL "
            f"WHEN {days} > 365 THEN printf('%d years ago', {days} // 365) "
            f"WHEN {days} > 30 THEN printf('%d months ago', {days} // 30) "
            f"WHEN {days} > 0 THEN printf('%d days ago', {days}) "
            f"WHEN {rem} >= 3600 THEN printf('%d hours ago', {rem} // 3600) "
            f"WHEN {rem} >= 60 THEN printf('%d minutes ago', {rem} // 60) ELSE 'just now' END")


_TOPIC_HOUR = """topic_hour AS (
  SELECT topic, hour, count(*) AS mention_count, CAST(sum(engagement_score) AS BIGINT) AS total_engagement,
         round(sum(engagement_score) / 100.0, 4) AS trend_score
  FROM (SELECT DISTINCT source, post_id, unnest(CASE source WHEN 'twitter' THEN ['update', event_type] WHEN 'reddit' THEN ['thread', event_type]
         ELSE ['friends', event_type] END) AS topic,
               date_trunc('hour', created_at) AS hour, engagement_score FROM silver)
  GROUP BY topic, hour
)"""

_HOURLY_SRC = """hourly AS (
  SELECT source, date_trunc('hour', created_at) AS hour, count(*) AS posts FROM silver GROUP BY 1, 2
)"""

Q = {}
Q["trending_top"] = with_silver("""
, tw AS (
SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, source,
       count(*) AS post_count, CAST(sum(engagement_score) AS BIGINT) AS total_engagement,
       round(avg(engagement_score), 4) AS avg_engagement,
       round(count(*) * avg(engagement_score) / 100, 4) AS trend_score
FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, created_at),
                        time_bucket(INTERVAL 30 MINUTE, created_at) - INTERVAL 30 MINUTE]) AS ws
      FROM silver)
GROUP BY ws, source)
SELECT * FROM tw ORDER BY trend_score DESC, window_start, source LIMIT 10""")
Q["window_posts"] = with_silver("""
SELECT ws AS window_start, source, post_id
FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, created_at),
                        time_bucket(INTERVAL 30 MINUTE, created_at) - INTERVAL 30 MINUTE]) AS ws
      FROM silver)""")
_SENTIMENT = ("CASE source WHEN 'twitter' THEN round(1 / 8, 4) WHEN 'reddit' THEN round(-1 / 13, 4)"
              " ELSE round(1 / 6, 4) END")
Q["silver_enriched"] = with_silver("""
SELECT source, post_id, CASE source WHEN 'twitter' THEN 'update,' WHEN 'reddit' THEN 'thread,' ELSE 'friends,' END
       || event_type AS topics, """ + _SENTIMENT + """ AS sentiment FROM silver""")
Q["unified_posts"] = with_unified("""
SELECT source, post_id, text, author, created_at, engagement, likes, retweets, hashtags, subreddit FROM unified""")
Q["count_by_source"] = with_rec("SELECT source, count(*) AS post_count FROM rec GROUP BY source")
Q["source_share"] = with_unified("""
SELECT source, count(*) AS posts, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct
FROM unified GROUP BY source""")
Q["kpi_totals"] = with_unified("""
SELECT count(*) AS total_posts, count(*) FILTER (WHERE source = 'Twitter') AS twitter_posts,
       count(*) FILTER (WHERE source = 'Reddit') AS reddit_posts,
       count(*) FILTER (WHERE source = 'Bluesky') AS bluesky_posts,
       CAST(coalesce(sum(engagement), 0) AS BIGINT) AS total_engagement FROM unified""")
Q["new_since"] = with_unified("""
SELECT count(*) AS total_posts, count(*) FILTER (WHERE processed_at <= TIMESTAMP '2024-01-30 00:00:00') AS previous_count,
       count(*) - count(*) FILTER (WHERE processed_at <= TIMESTAMP '2024-01-30 00:00:00') AS new_posts FROM unified""")
Q["distinct_sources"] = with_unified("SELECT DISTINCT source FROM unified")
Q["distinct_communities"] = with_unified("SELECT DISTINCT subreddit FROM unified WHERE subreddit IS NOT NULL")
Q["posts_by_day"] = with_unified(f"""
SELECT day, count(*) AS posts, {_day_label('day')} AS label
FROM (SELECT CAST(created_ts AS DATE) AS day FROM unified WHERE created_ts IS NOT NULL) GROUP BY day""")
Q["filter_source"] = with_unified(_VIEW + " WHERE source = 'Reddit'")
Q["filter_today"] = with_unified(_VIEW + f" WHERE CAST(created_ts AS DATE) = CAST({_AS_OF} AS DATE)")
Q["filter_yesterday"] = with_unified(_VIEW + f" WHERE CAST(created_ts AS DATE) = CAST({_AS_OF} AS DATE) - 1")
Q["filter_week"] = with_unified(_VIEW + f" WHERE created_ts >= {_AS_OF} - INTERVAL 7 DAY")
Q["filter_month"] = with_unified(_VIEW + f" WHERE created_ts >= {_AS_OF} - INTERVAL 30 DAY")
Q["filter_last_hours"] = with_unified(_VIEW + f" WHERE created_ts >= {_AS_OF} - INTERVAL 6 HOUR AND created_ts <= {_AS_OF}")
Q["filter_community"] = with_unified(_VIEW + " WHERE subreddit IN ('sub1', 'sub4')")
Q["recent_posts"] = with_unified(_VIEW + " ORDER BY created_ts DESC NULLS LAST, post_id, source LIMIT 50")
Q["hottest_posts"] = with_unified(_VIEW + " ORDER BY engagement DESC NULLS LAST, post_id, source LIMIT 50")
Q["card_fields"] = with_unified(f"""
SELECT source, post_id,
  CASE source WHEN 'Reddit' THEN 'badge-reddit' WHEN 'Bluesky' THEN 'badge-bluesky' ELSE 'badge-twitter' END AS badge,
  concat_ws(' • ', CASE WHEN subreddit IS NOT NULL AND subreddit <> '' THEN 'r/' || subreddit END,
            'by u/' || coalesce(author, 'Unknown'), {_age_bucket('created_ts')}) AS meta,
  substring(text, 1, 200) || '...' AS snippet,
  format('{{:,}}', coalesce(engagement, 0)) AS engagement_label
FROM unified""")
Q["cap_per_community"] = with_silver("""
SELECT community, post_id, created_at FROM silver WHERE community IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY community ORDER BY created_at DESC, post_id) <= 5""")
Q["count_by_community"] = with_silver(
    "SELECT community, count(*) AS posts FROM silver WHERE community IS NOT NULL GROUP BY community")
Q["user_activity"] = with_silver("""
SELECT author, count(*) AS posts, CAST(sum(engagement_score) AS BIGINT) AS total_engagement,
       round(avg(engagement_score), 4) AS avg_engagement,
       count(DISTINCT CAST(created_at AS DATE)) AS active_days, count(DISTINCT source) AS networks
FROM silver GROUP BY author""")
Q["top_authors"] = with_silver("""
SELECT author, count(*) AS posts, CAST(sum(engagement_score) AS BIGINT) AS total_engagement
FROM silver GROUP BY author ORDER BY posts DESC, total_engagement DESC, author LIMIT 10""")
Q["influencers"] = with_silver("""
, a AS (SELECT author, CAST(sum(engagement_score) AS BIGINT) AS total_engagement,
               round(avg(engagement_score), 4) AS avg_engagement, count(*) AS posts
        FROM silver GROUP BY author ORDER BY total_engagement DESC, author LIMIT 10)
SELECT *, dense_rank() OVER (ORDER BY total_engagement DESC) AS rank FROM a""")
Q["collection_tally"] = with_silver("""
SELECT source, count(*) AS collected,
       count(DISTINCT CASE WHEN post_id IS NOT NULL THEN community END) AS communities_ok,
       count(DISTINCT community) AS communities_tried
FROM silver GROUP BY source""")
Q["high_water_mark"] = with_silver(
    "SELECT source, max(TRY_CAST(post_id AS BIGINT)) AS since_id FROM silver GROUP BY source")
Q["incremental_since"] = with_silver("""
, marks AS (SELECT source, max(row(created_at, post_id)) AS since FROM silver
            WHERE created_at < TIMESTAMP '2024-01-20 00:00:00' GROUP BY source)
SELECT s.source, s.post_id FROM silver s LEFT JOIN marks m ON s.source = m.source
WHERE m.since IS NULL OR row(s.created_at, s.post_id) > m.since""")
Q["dedup_rate"] = with_silver("""
, per AS (SELECT source, post_id, count(*) AS n FROM silver_raw GROUP BY 1, 2)
SELECT source, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys,
       round(1 - count(*) / sum(n), 4) AS dup_rate FROM per GROUP BY source""")
Q["dedup_id"] = with_silver("SELECT source, post_id, topic_offset FROM silver")
Q["hourly_volume_pivot"] = with_silver("""
SELECT date_trunc('hour', created_at) AS hour,
       count(*) FILTER (WHERE source = 'twitter') AS twitter,
       count(*) FILTER (WHERE source = 'reddit') AS reddit,
       count(*) FILTER (WHERE source = 'bluesky') AS bluesky
FROM silver GROUP BY 1""")
Q["topic_hourly"] = with_silver(", " + _TOPIC_HOUR + " SELECT * FROM topic_hour")
Q["topic_timeseries"] = with_silver(", " + _TOPIC_HOUR + """
, grid AS (SELECT topic, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour
           FROM topic_hour GROUP BY topic)
SELECT g.topic, g.hour, coalesce(t.mention_count, 0) AS mention_count,
       coalesce(t.total_engagement, 0) AS total_engagement
FROM grid g LEFT JOIN topic_hour t ON g.topic = t.topic AND g.hour = t.hour""")
Q["topic_burst"] = with_silver(", " + _TOPIC_HOUR + """
, grid AS (SELECT topic, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour
           FROM topic_hour GROUP BY topic)
, filled AS (SELECT g.topic, g.hour, coalesce(t.mention_count, 0) AS mention_count
             FROM grid g LEFT JOIN topic_hour t ON g.topic = t.topic AND g.hour = t.hour)
, b AS (SELECT *, avg(mention_count) OVER (PARTITION BY topic ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS base
        FROM filled)
SELECT topic, hour, mention_count, round(base, 4) AS baseline,
       round(CASE WHEN base <> 0 THEN mention_count / base END, 4) AS ratio,
       coalesce(CASE WHEN base <> 0 THEN mention_count / base END > 2.0, false) AS is_burst FROM b""")
Q["topic_rank"] = with_silver(", " + _TOPIC_HOUR + """
SELECT *, dense_rank() OVER (PARTITION BY hour ORDER BY trend_score DESC, topic) AS rank FROM topic_hour""")
Q["top_posts_per_hour"] = with_silver("""
, t AS (SELECT DISTINCT unnest(CASE source WHEN 'twitter' THEN ['update', event_type] WHEN 'reddit' THEN ['thread', event_type]
         ELSE ['friends', event_type] END) AS topic, date_trunc('hour', created_at) AS hour,
               source, post_id, engagement_score FROM silver)
SELECT topic, hour, source, post_id, engagement_score,
       row_number() OVER (PARTITION BY topic, hour ORDER BY engagement_score DESC, post_id, source) AS rank
FROM t QUALIFY rank <= 3""")
Q["burst_detect"] = with_silver(", " + _HOURLY_SRC + """
, b AS (SELECT *, avg(posts) OVER (PARTITION BY source ORDER BY hour RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS base
        FROM hourly)
SELECT source, hour, posts, round(base, 4) AS baseline, round(posts / base, 4) AS ratio,
       coalesce(posts / base > 2.0, false) AS is_burst FROM b""")
Q["heat_score"] = with_silver(", " + _TOPIC_HOUR + f"""
SELECT *, round(mention_count * total_engagement /
                pow(2.0, greatest((epoch({_AS_OF}) - epoch(hour)) / 3600.0, 0.0) / 24.0), 4) AS heat
FROM topic_hour""")
Q["period_change"] = with_silver("""
, d AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS posts FROM silver GROUP BY 1)
SELECT day, posts, lag(posts) OVER (ORDER BY day) AS previous,
       round((posts - lag(posts) OVER (ORDER BY day)) * 100.0 / lag(posts) OVER (ORDER BY day), 4) AS change_pct
FROM d""")
Q["weekly_report"] = with_silver("""
SELECT date_trunc('week', created_at) AS period, source, count(*) AS posts,
       CAST(sum(engagement_score) AS BIGINT) AS total_engagement, count(DISTINCT author) AS authors
FROM silver GROUP BY 1, 2""")


TRENDING_WINDOWS = with_silver("""
SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, source,
       count(*) AS post_count, CAST(sum(engagement_score) AS BIGINT) AS total_engagement,
       round(avg(engagement_score), 4) AS avg_engagement,
       round(count(*) * avg(engagement_score) / 100, 4) AS trend_score
FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, created_at),
                        time_bucket(INTERVAL 30 MINUTE, created_at) - INTERVAL 30 MINUTE]) AS ws
      FROM silver)
GROUP BY ws, source""")


def oracle_sql() -> dict[str, str]:
    return {"trending_windows": TRENDING_WINDOWS, **Q, **_text_sql(), **_model_sql()}


# ------------------------------------------------------------------ text
def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _text_sql():
    from ..functions import lexicon as L

    stop = _list(L.phrase_stop_words())
    generic = _list(L.GENERIC_WORDS)
    excluded = _list(L.EXCLUDED_PHRASES)
    toks = "list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '')"
    line = "(' ' || array_to_string(" + toks + ", ' ') || ' ')"
    words_of = ("list_filter(regexp_split_to_array(trim(lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}]', ' ', 'g'))),"
                " '[\\s\\p{{Z}}]+'), lambda w: w <> '')")
    out = {}
    grams = []
    for n in (2, 3, 4):
        grams.append(
            f"list_transform(list_filter(CASE WHEN len(t) >= {n} THEN generate_series(1, len(t) - {n - 1}) ELSE [] END,"
            f" lambda i: list_bool_and(list_transform(t[i:i + {n - 1}], lambda w: NOT list_contains({stop}, w)"
            f" AND NOT regexp_full_match(w, '\\p{{Nd}}+')))"
            f" AND NOT list_contains({generic}, t[i]) AND NOT list_contains({generic}, t[i + {n - 1}])),"
            f" lambda i: array_to_string(t[i:i + {n - 1}], ' '))")
    topn = f"""
phr_src AS (
  SELECT unnest(regexp_split_to_array(regexp_replace(text, 'http[^\\s\\p{{Z}}]+|www[^\\s\\p{{Z}}]+', '', 'g'), '[.!?;:]+|\\n')) AS seg
  FROM documents
), toks AS (SELECT {words_of.format(x='seg')} AS t FROM phr_src
), grams AS (SELECT unnest(flatten([{', '.join(grams)}])) AS keyword FROM toks
), phr_all AS (SELECT keyword, count(*) AS mentions FROM grams
               WHERE length(keyword) >= 8 AND NOT list_contains({excluded}, keyword) GROUP BY keyword
), wrd_all AS (
  SELECT keyword, count(*) AS mentions FROM (
    SELECT unnest({words_of.format(x="regexp_replace(text, 'http[^\\s\\p{Z}]+|www[^\\s\\p{Z}]+', '', 'g')")}) AS keyword FROM documents)
  WHERE length(keyword) >= 4 AND NOT list_contains({stop}, keyword) AND NOT list_contains({generic}, keyword)
    AND regexp_full_match(keyword, '\\p{{L}}+') AND NOT starts_with(keyword, 'ai')
  GROUP BY keyword
)"""

    def topn_body(n):
        return f"""
, phr AS (SELECT * FROM phr_all ORDER BY mentions DESC, keyword LIMIT {n})
, wrd AS (SELECT * FROM wrd_all ORDER BY mentions DESC, keyword LIMIT {n})
, both_ AS (SELECT *, 0 AS kind FROM phr UNION ALL SELECT *, 1 AS kind FROM wrd)
, merged AS (SELECT keyword, mentions FROM both_ WHERE kind = 0 OR (SELECT count(*) FROM phr) < 5
             QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY kind DESC) = 1)
, top AS (SELECT * FROM merged ORDER BY mentions DESC, keyword LIMIT {n})"""

    out["keyword_topn"] = "WITH " + topn + topn_body(20) + "\nSELECT * FROM top"
    out["cloud_weights"] = ("WITH " + topn + topn_body(100) + """
, best AS (SELECT trim(regexp_replace(keyword, '\\s+', ' ', 'g')) AS keyword, mentions FROM top
           ORDER BY mentions DESC, keyword LIMIT 50)
SELECT keyword, mentions, round(mentions / max(mentions) OVER (), 4) AS weight FROM best""")
    cell = lambda k, row, column: f"CASE WHEN {k} > 0 THEN {k} * ln({k} * total / (({row}) * ({column}))) ELSE 0.0 END"
    good = " AND ".join(f"NOT list_contains({stop}, {w}) AND NOT list_contains({generic}, {w}) AND NOT regexp_full_match({w}, '\\p{{Nd}}+')" for w in "ab")
    out["collocations"] = "WITH " + topn.split("), grams AS")[0] + f""")
, p AS (SELECT t[i] AS a, t[i + 1] AS b FROM (SELECT t, unnest(generate_series(1, len(t) - 1)) AS i FROM toks))
, c AS (SELECT a, b, count(*) AS n FROM p WHERE {good} GROUP BY a, b)
, x AS (SELECT a, b, n, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER () AS total FROM c)
SELECT a || ' ' || b AS keyword, n AS mentions,
       round(2 * ({cell("n", "na", "nb")} + {cell("(na - n)", "na", "total - nb")} + {cell("(nb - n)", "total - na", "nb")}
                  + {cell("(total - na - nb + n)", "total - na", "total - nb")}), 4) AS score
FROM x WHERE n >= 5 AND n * total > na * nb ORDER BY score DESC, keyword LIMIT 50"""
    from .catalog import FILTER_TERMS, SEARCH_TERMS, TOPIC_TERMS

    topics = _list([t.lower() for t in TOPIC_TERMS])
    doc_line = line.format(x="text")
    out["topic_mentions"] = (f"SELECT doc_id, unnest(list_filter({topics}, lambda k: contains({doc_line}, ' ' || k || ' ')))"
                             f" AS topic FROM documents")
    out["topic_top10"] = (f"WITH m AS ({out['topic_mentions']}) SELECT topic, count(*) AS mentions FROM m"
                          f" GROUP BY topic ORDER BY mentions DESC, topic LIMIT 10")
    any_f = " OR ".join(f"contains({doc_line}, {_q(' ' + t + ' ')})" for t in FILTER_TERMS)
    out["keyword_filter"] = f"SELECT doc_id, source FROM documents WHERE {any_f}"
    out["keyword_filter_lang"] = (f"SELECT doc_id, source FROM documents WHERE ({any_f}) AND lang = 'en'"
                                  f" AND NOT starts_with(text, 'RT @')")
    out["sql_like_count"] = "SELECT source, count(*) AS docs FROM documents WHERE text LIKE '%tion%' GROUP BY source"
    out["filter_lang"] = "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'zh')"
    dt = toks.format(x="text")
    pos, neg = _list(L.POSITIVE_WORDS), _list(L.NEGATIVE_WORDS)
    out["sentiment"] = f"""
WITH s AS (SELECT doc_id, {dt} AS t FROM documents),
s2 AS (SELECT doc_id, len(list_filter(t, lambda w: list_contains({pos}, w))) AS positive,
              len(list_filter(t, lambda w: list_contains({neg}, w))) AS negative, len(t) AS n FROM s)
SELECT doc_id, positive, negative,
       round(CASE WHEN n > 0 THEN (positive - negative) / n ELSE 0.0 END, 4) AS sentiment,
       CASE WHEN round(CASE WHEN n > 0 THEN (positive - negative) / n ELSE 0.0 END, 4) > 0.05 THEN 'positive'
            WHEN round(CASE WHEN n > 0 THEN (positive - negative) / n ELSE 0.0 END, 4) < -0.05 THEN 'negative'
            ELSE 'neutral' END AS label
FROM s2"""
    votes = ", ".join(f"len(list_filter(t, lambda w: list_contains({_list(L.stop_words(name))}, w))) AS v_{code}"
                      for code, name in L.LANGUAGES.items())
    best, best_n = "CAST(NULL AS VARCHAR)", "0"
    for code in L.LANGUAGES:
        best = f"CASE WHEN v_{code} > {best_n} THEN '{code}' ELSE {best} END"
        best_n = f"greatest({best_n}, v_{code})"
    out["detect_lang"] = f"""
WITH s AS (SELECT doc_id, lang, coalesce(text, '') AS txt, {dt} AS t FROM documents),
v AS (SELECT doc_id, lang, txt, {votes} FROM s)
SELECT doc_id, lang,
  CASE WHEN length(txt) > 0 AND length(regexp_replace(txt, '[^\\p{{Han}}]', '', 'g')) * 3 > length(txt) THEN 'zh'
       ELSE coalesce({best}, 'und') END AS detected
FROM v"""
    tagged = "'#' || source || ' #' || lang || ' ' || text"
    out["extract_tags"] = f"""
SELECT doc_id, array_to_string(regexp_extract_all({tagged}, '#([\\p{{L}}\\p{{N}}_]+)', 1), ',') AS hashtags,
       array_to_string(regexp_extract_all({tagged}, '@([\\p{{L}}\\p{{N}}_.]+)', 1), ',') AS mentions
FROM documents"""
    out["clean_html"] = f"SELECT page_id, {clean_html_sql('html')} AS text FROM pages"
    out["uri_tail"] = "SELECT page_id, split(url, '/')[-1] AS tail FROM pages"
    union = " UNION ALL ".join(
        f"SELECT doc_id, {_q(t)} AS term, {i} AS o FROM documents WHERE contains({doc_line}, {_q(' ' + t + ' ')})"
        for i, t in enumerate(SEARCH_TERMS))
    out["search_union_dedup"] = (f"SELECT doc_id, term FROM ({union}) "
                                 f"QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY o) = 1")
    out["post_features"] = f"""
WITH s AS (SELECT doc_id, text, {dt} AS t FROM documents),
s2 AS (SELECT doc_id, text, t, len(list_filter(t, lambda w: list_contains({pos}, w))) AS p,
              len(list_filter(t, lambda w: list_contains({neg}, w))) AS ng FROM s)
SELECT doc_id, length(text) AS n_chars, len(t) AS words,
       len(list_filter({topics}, lambda k: contains(' ' || array_to_string(t, ' ') || ' ', ' ' || k || ' '))) AS keyword_hits,
       round(CASE WHEN len(t) > 0 THEN (p - ng) / len(t) ELSE 0.0 END, 4) AS sentiment
FROM s2"""
    url_free = "regexp_replace(text, 'http[^\\s\\p{Z}]+|www[^\\s\\p{Z}]+', '', 'g')"
    wrd = (f"list_filter({words_of.format(x=url_free)},"
           f" lambda w: length(w) >= 4 AND NOT list_contains({stop}, w) AND NOT list_contains({generic}, w)"
           f" AND regexp_full_match(w, '\\p{{L}}+') AND NOT starts_with(w, 'ai'))")
    parts = "regexp_split_to_array(regexp_replace(text, 'http[^\\s\\p{Z}]+|www[^\\s\\p{Z}]+', '', 'g'), '[.!?;:]+|\\n')"
    out["sql_phrases"] = f"""
WITH s AS (SELECT doc_id, unnest({parts}) AS seg FROM documents),
t AS (SELECT doc_id, {words_of.format(x='seg')} AS t FROM s),
g AS (SELECT doc_id, unnest(flatten([{', '.join(grams)}])) AS g FROM t)
SELECT d.doc_id, count(g) AS phrases, count(DISTINCT g) AS distinct_phrases
FROM documents d LEFT JOIN (SELECT * FROM g WHERE length(g) >= 8 AND NOT list_contains({excluded}, g)) g ON d.doc_id = g.doc_id
GROUP BY d.doc_id"""
    det = out["detect_lang"].replace("SELECT doc_id, lang,", "SELECT doc_id,")
    snt = out["sentiment"]
    out["sql_functions"] = f"""
WITH det AS ({det}), snt AS ({snt}),
kw AS (SELECT doc_id, len({wrd}) AS keywords FROM documents)
SELECT d.doc_id AS id, 'doc' AS kind, d.detected, s.sentiment, k.keywords, CAST(NULL AS VARCHAR) AS clean
FROM det d JOIN snt s ON d.doc_id = s.doc_id JOIN kw k ON d.doc_id = k.doc_id
UNION ALL
SELECT page_id, 'page', NULL, NULL, NULL, {clean_html_sql('html')} FROM pages"""
    return out


SEMANTIC_TOPK = """
WITH ex AS (SELECT label, unnest(generate_series(1, len(embedding))) AS pos,
                   unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
c AS (SELECT label, list(x ORDER BY pos) AS centroid
      FROM (SELECT label, pos, avg(x) AS x FROM ex GROUP BY label, pos) GROUP BY label),
s AS (SELECT e.label, e.vec_id,
             list_sum(list_transform(list_zip(CAST(e.embedding AS DOUBLE[]), c.centroid), lambda p: p[1] * p[2]))
             / (sqrt(list_sum(list_transform(CAST(e.embedding AS DOUBLE[]), lambda v: v * v)))
                * sqrt(list_sum(list_transform(c.centroid, lambda v: v * v)))) AS score
      FROM embeddings e JOIN c ON e.label = c.label)
SELECT label, vec_id, round(score, 4) AS score,
       row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank
FROM s QUALIFY rank <= 5"""

Q["semantic_topk"] = SEMANTIC_TOPK
Q["semantic_search"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
s AS (SELECT a.vec_id, q.vec_id AS query_id,
             round(list_sum(list_transform(list_zip(a.e, q.e), lambda p: p[1] * p[2])) / (a.norm * q.norm), 6) AS score
      FROM n a JOIN n q ON q.vec_id % 100 = 0)
SELECT vec_id, query_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM s WHERE score IS NOT NULL QUALIFY rank <= 10"""
Q["hashtag_counts"] = with_silver(
    "SELECT lower(unnest(hashtags)) AS hashtag, count(*) AS posts FROM silver GROUP BY 1")
Q["clean_text"] = with_silver(f""", t AS (
  SELECT s.source, s.post_id, r.event_type, r.user_id, r.a, r.sub FROM silver s JOIN rec r
    ON s.topic_partition = r.topic_partition AND s.topic_offset = r.topic_offset)
SELECT source, post_id,
  CASE source
    WHEN 'twitter' THEN regexp_replace(lower('Update ' || post_id || ' from @user' || CAST(user_id AS VARCHAR) || ': #'
         || event_type || ' is up, see http://t.co/p' || post_id || ' and www.ex.com/' || CAST(user_id AS VARCHAR)),
         'http[^\\s\\p{{Z}}]+|www[^\\s\\p{{Z}}]+|@[^\\s\\p{{Z}}]+|#', '', 'g')
    WHEN 'reddit' THEN regexp_replace(lower('Thread ' || post_id || ' &amp; ' || event_type || ' <p>Score '
         || CAST(a AS VARCHAR) || '</p>  for &lt;i&gt;' || sub || ' http://r.co/' || post_id), 'http[^\\s\\p{{Z}}]+|www[^\\s\\p{{Z}}]+', '', 'g')
    ELSE regexp_replace(lower('Note ' || post_id || ' #' || event_type || ' with @user' || CAST(user_id AS VARCHAR)
         || '.bsky.social  &amp;  friends'), 'http[^\\s\\p{{Z}}]+|www[^\\s\\p{{Z}}]+|@[^\\s\\p{{Z}}]+|#', '', 'g')
  END AS text_clean
FROM t""")

# --------------------------------------------------------------- sources
Q["scan_all"] = with_rec("SELECT topic_partition, topic_offset, source, post_id FROM rec")
Q["scan_tail_n"] = with_rec("""
, p AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY topic_partition ORDER BY topic_offset DESC) <= 50)
SELECT topic_partition AS partition, topic_offset AS "offset", post_id AS key FROM p
ORDER BY topic_ts DESC, topic_offset DESC, topic_partition LIMIT 50""")
Q["end_offset_total"] = with_rec("""
, p AS (SELECT topic_partition, max(topic_offset) + 1 AS e, count(*) AS n FROM rec GROUP BY 1)
SELECT count(*) AS partitions, CAST(sum(e) AS BIGINT) AS end_offset_total, CAST(sum(n) AS BIGINT) AS message_count
FROM p""")
Q["replay_from"] = with_rec("""
SELECT topic_partition AS partition, topic_offset AS "offset", post_id AS key FROM rec
WHERE (topic_partition = 0 AND topic_offset >= 1000) OR (topic_partition = 1 AND topic_offset >= 2000)
   OR topic_partition NOT IN (0, 1)""")
Q["envelope_json"] = with_rec("""
SELECT source, post_id, iso AS sent_at, CASE WHEN source IN ('twitter', 'bluesky') THEN a END AS likes FROM rec""")
Q["quarantine"] = with_rec("""
SELECT text AS payload, 'malformed envelope' AS error, CAST(doc_id % 3 AS INTEGER) AS topic_partition,
       doc_id + 2000000000000 AS topic_offset FROM documents""")
Q["parse_yield"] = with_rec("""
SELECT count(*) AS records, count(source) AS parsed,
       count(*) FILTER (WHERE source IN ('twitter', 'reddit', 'bluesky')) AS known_source,
       round(count(source) / count(*), 4) AS parse_rate
FROM (SELECT source FROM rec UNION ALL SELECT NULL FROM documents)""")
Q["json_nested"] = with_rec("""
SELECT source, post_id, CASE WHEN source IN ('twitter', 'bluesky') THEN a END AS likes,
       CASE WHEN source = 'reddit' THEN a END AS score FROM rec""")
Q["array_ops"] = with_silver("""
SELECT source, post_id, len(hashtags) AS num_hashtags,
       CAST(CASE WHEN source = 'reddit' THEN 0 ELSE 1 END AS BIGINT) AS num_mentions,
       array_to_string(hashtags, ',') AS tags, array_to_string(hashtags, ',') AS tag_objects,
       coalesce(hashtags[1], 'none') AS first_tag FROM silver""")
Q["parse_time"] = """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN date_trunc('second', ts) ELSE ts END AS parsed FROM events"""
Q["format_time"] = """
SELECT event_id, strftime(ts, '%H:%M:%S') AS hms, strftime(ts, '%Y-%m-%d') AS ymd,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events"""
Q["age_bucket"] = f"SELECT event_id, {_age_bucket('ts')} AS age FROM events"
Q["engagement_scores"] = with_silver("SELECT source, post_id, engagement_score, engagement FROM silver")

# ----------------------------------------------------------------- joins
Q["enrich_author"] = """
SELECT o.o_orderkey, o.o_custkey, c.c_name AS author_name, coalesce(c.c_mktsegment = 'BUILDING', false) AS verified
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""
Q["new_only_anti"] = with_silver("""
SELECT source, post_id FROM silver b WHERE created_at >= TIMESTAMP '2024-01-15 00:00:00'
AND NOT EXISTS (SELECT 1 FROM silver s WHERE s.created_at < TIMESTAMP '2024-01-20 00:00:00'
                AND s.source = b.source AND s.post_id = b.post_id)""")
Q["seen_history_cap"] = with_silver("""
SELECT source, post_id FROM silver
QUALIFY row_number() OVER (PARTITION BY source ORDER BY created_at DESC, post_id) <= 5000
     OR count(*) OVER (PARTITION BY source) <= 10000""")
_VERSIONS = """
, base AS (SELECT source, post_id, engagement_score, topic_ts AS version, 0 AS side FROM silver
           WHERE created_at < TIMESTAMP '2024-01-20 00:00:00')
, upd AS (SELECT source, post_id, engagement_score + 100 AS engagement_score, topic_ts + INTERVAL 1 DAY AS version,
                 1 AS side FROM silver WHERE created_at >= TIMESTAMP '2024-01-15 00:00:00')
, h AS (SELECT * FROM base UNION ALL SELECT * FROM upd)"""
Q["upsert_latest"] = with_silver(_VERSIONS + """
SELECT source, post_id, engagement_score, version FROM h
QUALIFY row_number() OVER (PARTITION BY source, post_id ORDER BY version DESC, side DESC) = 1""")
Q["as_of_read"] = with_silver(_VERSIONS + """
SELECT source, post_id, engagement_score FROM h WHERE version <= TIMESTAMP '2024-01-25 00:00:00'
QUALIFY row_number() OVER (PARTITION BY source, post_id ORDER BY version DESC) = 1""")

# ------------------------------------------------------------------ lake
_PCOUNT = "SELECT CAST(topic_ts AS DATE) AS partition_date, source, count(*) AS rows FROM rec"
Q["bronze_scan"] = with_rec(_PCOUNT + " GROUP BY 1, 2")
Q["partition_read"] = with_rec("""
SELECT post_id, topic_offset FROM rec WHERE CAST(topic_ts AS DATE) = DATE '2024-01-15' AND source = 'reddit'""")
Q["retention_keep"] = with_rec(_PCOUNT + f" WHERE CAST(topic_ts AS DATE) >= CAST({_AS_OF} AS DATE) - 7 GROUP BY 1, 2")
Q["delete_where"] = with_rec(
    _PCOUNT + " WHERE NOT (source = 'reddit' AND CAST(topic_ts AS DATE) < DATE '2024-01-10') GROUP BY 1, 2")
Q["compact"] = with_rec(_PCOUNT + " GROUP BY 1, 2")
Q["zorder"] = with_silver("SELECT source, post_id, engagement_score FROM silver")
Q["merge_schema"] = with_silver("""
SELECT source, count(*) AS rows, count(*) FILTER (WHERE source <> 'reddit') AS with_language,
       count(*) FILTER (WHERE source = 'reddit') AS with_community FROM silver GROUP BY source""")

# ---------------------------------------------------------------- models
_NOW = f"date_trunc('hour', {_AS_OF})"
_HOURLY_GRID = f"""
, recent AS (SELECT * FROM silver WHERE created_at >= {_NOW} - INTERVAL 30 DAY AND created_at < {_NOW})
, cnt AS (SELECT source, date_trunc('hour', created_at) AS hour, count(*) AS posts FROM recent GROUP BY 1, 2)
, grid AS (SELECT source, unnest(generate_series({_NOW} - INTERVAL 30 DAY, {_NOW} - INTERVAL 1 HOUR, INTERVAL 1 HOUR))
                  AS hour FROM (SELECT DISTINCT source FROM recent))
, h AS (SELECT g.source, g.hour, coalesce(c.posts, 0) AS posts FROM grid g LEFT JOIN cnt c
        ON g.source = c.source AND g.hour = c.hour)"""
_X = f"((epoch({{h}}) - epoch({_NOW} - INTERVAL 30 DAY)) / 3600)"
_HOW = "(CAST(floor(epoch({h}) / 3600) AS BIGINT) % 168)"
Q["forecast_volume"] = with_silver(_HOURLY_GRID + f"""
, hx AS (SELECT *, {_X.format(h='hour')} AS x FROM h)
, fit AS (SELECT source, regr_slope(posts, x) AS slope, regr_intercept(posts, x) AS intercept FROM hx GROUP BY source)
, resid AS (SELECT hx.source, {_HOW.format(h='hx.hour')} AS how,
                   avg(hx.posts - (fit.intercept + fit.slope * hx.x)) AS season
            FROM hx JOIN fit ON hx.source = fit.source GROUP BY 1, 2)
, fut AS (SELECT source, slope, intercept,
                 unnest(generate_series({_NOW}, {_NOW} + INTERVAL 167 HOUR, INTERVAL 1 HOUR)) AS hour FROM fit)
SELECT f.source, f.hour,
       round(greatest(f.intercept + f.slope * {_X.format(h='f.hour')} + coalesce(r.season, 0.0), 0.0), 4) AS forecast
FROM fut f LEFT JOIN resid r ON f.source = r.source AND {_HOW.format(h='f.hour')} = r.how""")
Q["anomaly_flag"] = with_silver(_HOURLY_GRID + """
, med AS (SELECT source, quantile_cont(posts, 0.5) AS med FROM h GROUP BY source)
, dev AS (SELECT h.*, med.med, abs(h.posts - med.med) AS dev FROM h JOIN med ON h.source = med.source)
, mad AS (SELECT source, quantile_cont(dev, 0.5) AS mad FROM dev GROUP BY source)
, z AS (SELECT dev.source, dev.hour, dev.posts,
               round(CASE WHEN mad.mad > 0 THEN 0.6745 * (dev.posts - dev.med) / mad.mad ELSE 0.0 END, 4) AS robust_z
        FROM dev JOIN mad ON dev.source = mad.source)
SELECT *, abs(robust_z) > 3.5 AS is_anomaly FROM z""")
Q["dq_checks"] = with_silver(f"""
, b AS (SELECT count(*) AS n_b, count(*) FILTER (WHERE source NOT IN ('twitter', 'reddit', 'bluesky')) AS unk FROM rec)
, p AS (SELECT count(*) AS n_p, count(*) FILTER (WHERE created_at > {_AS_OF}) AS fut,
               count(*) FILTER (WHERE engagement_score < 0) AS neg FROM silver_raw)
, k AS (SELECT source, post_id, count(*) AS c FROM silver_raw GROUP BY 1, 2)
, d AS (SELECT CAST(sum(c - 1) AS BIGINT) AS dup, CAST(sum(c) AS BIGINT) AS n_d FROM k)
, r AS (
  SELECT 'unknown_source' AS rule, unk AS failed, n_b AS checked FROM b
  UNION ALL SELECT 'missing_id', 0, n_b FROM b
  UNION ALL SELECT 'bad_time', 0, n_p FROM p
  UNION ALL SELECT 'future_time', fut, n_p FROM p
  UNION ALL SELECT 'negative_engagement', neg, n_p FROM p
  UNION ALL SELECT 'empty_text', 0, n_p FROM p
  UNION ALL SELECT 'missing_metrics', 0, n_p FROM p
  UNION ALL SELECT 'duplicate_rows', dup, n_d FROM d)
SELECT rule, failed, checked, round(failed / checked, 4) AS fail_rate FROM r""")

# ------------------------------------------------------------------ logs
_LOG_LINES = """
lines AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'twitter' WHEN 1 THEN 'reddit' ELSE 'bluesky' END || '_collector.log' AS file,
         ts,
         strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - ' || CASE event_type
           WHEN 'error' THEN '❌ Error: connection failed for request ' || CAST(event_id AS VARCHAR)
           WHEN 'signup' THEN 'Rate limit reached (429), sleeping'
           ELSE 'Collected and sent post ' || CAST(event_id AS VARCHAR) END AS line
  FROM events)"""


def _tail(n: int) -> str:
    return (f", tail AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY ts DESC, line DESC) AS pos"
            f" FROM lines WHERE ts <= {_AS_OF} QUALIFY pos <= {n})")


Q["log_tail"] = "WITH " + _LOG_LINES + _tail(10) + " SELECT file, ts, line, pos FROM tail"
Q["collector_health"] = "WITH " + _LOG_LINES + _tail(20) + f"""
, a AS (SELECT file, bool_or(regexp_matches(line, '(?i)rate limit|429|too many requests')) AS rate_limited,
               bool_or(regexp_matches(line, '(?i)successfully|✅|sent to kafka|collected and sent')) AS last_success,
               bool_or(regexp_matches(line, '(?i)error|❌|failed')) AS has_error, max(ts) AS last_line_at
        FROM tail GROUP BY file)
SELECT file, rate_limited, last_success, has_error, last_line_at,
  CASE WHEN CAST(floor(epoch({_AS_OF})) AS BIGINT) - CAST(floor(epoch(last_line_at)) AS BIGINT) > 300 THEN 'idle'
       WHEN rate_limited THEN 'limited' WHEN last_success THEN 'running' WHEN has_error THEN 'error'
       ELSE 'idle' END AS status
FROM a"""

# ------------------------------------------------------------- streaming
Q["stream_envelope"] = with_rec("SELECT source, post_id, topic_offset FROM rec")
Q["bronze_roundtrip"] = Q["bronze_scan"]
Q["stream_restart"] = Q["bronze_scan"]
Q["stream_count_by_source"] = Q["count_by_source"]
Q["sql_stream"] = with_rec("""
SELECT source, count(*) AS post_count FROM rec
WHERE source = 'twitter' AND ('Update ' || post_id || ' from @' || uname || ':') LIKE '%from @user1%'
GROUP BY source""")
Q["stream_dedup"] = with_silver("SELECT source, post_id FROM silver")
Q["stream_trending"] = TRENDING_WINDOWS + """
HAVING ws + INTERVAL 1 HOUR <= (SELECT max(created_at) FROM silver) - INTERVAL 10 MINUTE"""
Q["stream_fanout"] = Q["count_by_source"]
Q["stream_parse_yield"] = Q["parse_yield"]
Q["medallion_e2e"] = TRENDING_WINDOWS


# ------------------------------------------------------ per-network silver
def _silver_net(src: str) -> str:
    return with_silver(f"""
SELECT source, post_id, author, created_at, language, community, likes, shares, replies, quotes,
       engagement_score, len(hashtags) AS num_hashtags,
       CAST(CASE WHEN source = 'reddit' THEN 0 ELSE 1 END AS BIGINT) AS num_mentions, topic_offset
FROM silver_raw WHERE source = '{src}'""")


Q["silver_twitter"] = _silver_net("twitter")
Q["silver_reddit"] = _silver_net("reddit")
Q["silver_bluesky"] = _silver_net("bluesky")
Q["latest_feed"] = with_unified(_VIEW + " ORDER BY created_ts DESC NULLS LAST, post_id, source LIMIT 20")


def _related_sql(n_funcs: int = 8, band: int = 2) -> str:
    sig = ", ".join(f"list_min(list_transform(toks, lambda w: md5('{i}:' || w)))" for i in range(n_funcs))
    bands = ", ".join("concat_ws('|', " + ", ".join(f"sig[{b * band + j + 1}]" for j in range(band)) + ")"
                      for b in range(n_funcs // band))
    return f"""
WITH t AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
                                                   lambda w: w <> '')) AS toks FROM documents),
s AS (SELECT doc_id, [{sig}] AS sig FROM t),
b AS (SELECT doc_id, unnest(generate_series(0, {n_funcs // band - 1})) AS band, unnest([{bands}]) AS bucket FROM s),
m AS (SELECT band, bucket, min(doc_id) AS g, count(*) AS n FROM b GROUP BY 1, 2)
SELECT b.doc_id, min(m.g) AS group_id, max(m.n) AS bucket_size, max(m.n) > 1 AS related
FROM b JOIN m ON b.band = m.band AND b.bucket = m.bucket GROUP BY b.doc_id"""


Q["related_docs"] = _related_sql()


def _crc_step(k: int) -> int:
    for _ in range(8):
        k = (k >> 1) ^ (0xEDB88320 if k & 1 else 0)
    return k


def _related_classes_sql() -> str:
    """All pairs that share a band, verified; classes by recursion over the links. DuckDB has no crc32, so it is folded
    over the bytes of each distinct word."""
    crc_table = [_crc_step(k) for k in range(256)]
    least = ", ".join(f"min(({a} * x + {b}) % {REL.PRIME}) AS m{i}" for i, (a, b) in enumerate(REL.multipliers()))
    bands = ", ".join("concat_ws('|', " + ", ".join(f"m{b * REL.ROWS + r}" for r in range(REL.ROWS)) + ")" for b in range(REL.BANDS))
    return f"""
WITH RECURSIVE w AS (
  SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '')) AS word
  FROM documents),
crc AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(word))),
               lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT))),
               lambda c, b: xor({crc_table}[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS x
        FROM (SELECT DISTINCT word FROM w)),
x AS (SELECT doc_id, x FROM w JOIN crc USING (word)),
s AS (SELECT doc_id, count(*) AS n, {least} FROM x GROUP BY doc_id),
p AS (SELECT doc_id, unnest(generate_series(1, {REL.BANDS})) AS band, unnest([{bands}]) AS bucket FROM s),
c AS (SELECT DISTINCT p.doc_id AS a, q.doc_id AS b FROM p JOIN p q ON p.band = q.band AND p.bucket = q.bucket AND p.doc_id < q.doc_id),
shared AS (SELECT a, b, count(*) AS n FROM c JOIN w u ON u.doc_id = a JOIN w v ON v.doc_id = b AND u.word = v.word GROUP BY a, b),
l AS (SELECT a, b FROM shared JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b
      WHERE shared.n >= {REL.RATIO} * (p.n + q.n - shared.n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
k AS (SELECT doc_id, min(other) AS class_id FROM r GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM k"""


Q["related_classes"] = _related_classes_sql()


def _features_sql() -> str:
    from .catalog import POST_NEGATIVE, POST_POSITIVE, POST_TOPICS

    topics, pos, neg = _list(POST_TOPICS), _list(POST_POSITIVE), _list(POST_NEGATIVE)
    return f"""
worded AS (SELECT source, post_id, text_clean, list_filter(regexp_split_to_array(lower(text_clean), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '') AS words
           FROM ({Q["clean_text"]})),
posts AS (
  SELECT w.source, w.post_id, CAST(length(text_clean) AS DOUBLE) AS post_length,
         s.engagement_score / (1 + greatest(CAST(floor(epoch({_AS_OF})) AS BIGINT) - CAST(floor(epoch(s.created_at)) AS BIGINT), 0) / 3600) AS engagement_rate,
         CAST(len(list_distinct(list_concat(
           list_filter({topics}, lambda k: contains(' ' || array_to_string(words, ' ') || ' ', ' ' || k || ' ')),
           list_transform(s.hashtags, lambda h: lower(h))))) AS DOUBLE) AS keyword_count,
         (len(list_filter(words, lambda w: list_contains({pos}, w))) - len(list_filter(words, lambda w: list_contains({neg}, w))))
           / greatest(len(words), 1) AS sentiment
  FROM worded w JOIN silver s ON w.source = s.source AND w.post_id = s.post_id)"""


def _forest_sql() -> str:
    """The same forest level by level: sample rows and posts go down the trees side by side."""
    t, s, n = OUT.TREES, OUT.SAMPLE, len(OUT.FEATURES)
    depth = (s - 1).bit_length()
    code = lambda end: f"CAST('0x' || substr(md5(tree || ':' || code || '{end}'), 1, 7) AS BIGINT)"
    path = (f"CASE WHEN n < 2 THEN 0.0 WHEN n = 2 THEN 1.0 ELSE 2 * (ln(n - 1) + {OUT.EULER}) - 2 * (n - 1) / n END")
    order = ", ".join(f"({code('')} + {k}) % {n} + 1" for k in range(n))
    steps = []
    for level in range(depth + 1):
        low, high = (", ".join(f"{f}(f[{k + 1}])" for k in range(n)) for f in ("min", "max"))
        last = "true" if level == depth else "n < 2"
        steps.append(f"""
stats{level} AS (SELECT tree, code, count(*) AS n, [{low}] AS lo, [{high}] AS hi FROM rows{level} GROUP BY tree, code),
split{level} AS (
  SELECT tree, code, n, CASE WHEN {last} THEN NULL ELSE list_filter([{order}], lambda k: lo[k] < hi[k])[1] END AS j,
         list_transform(lo, lambda x, i: x + (hi[i] - x) * (({code('/')} + 0.5) / {OUT.HASH})) AS cut FROM stats{level}),
leaf{level} AS (SELECT source, post_id, {level} + {path} AS path FROM down{level} JOIN split{level} USING (tree, code) WHERE j IS NULL)""")
        if level < depth:
            for name in ("rows", "down"):
                keys = "" if name == "rows" else "source, post_id, "
                steps.append(f"""
{name}{level + 1} AS (SELECT {keys}tree, code || CASE WHEN f[j] < cut[j] THEN '0' ELSE '1' END AS code, f
                  FROM {name}{level} JOIN split{level} USING (tree, code) WHERE j IS NOT NULL)""")
    leaves = " UNION ALL ".join(f"SELECT * FROM leaf{level}" for level in range(depth + 1))
    return "WITH " + SILVER + "," + _features_sql() + f""",
numbered AS (SELECT [{", ".join(OUT.FEATURES)}] AS f, source, post_id,
                    row_number() OVER (ORDER BY md5(concat_ws('|', source, post_id)), {", ".join(OUT.FEATURES)}) - 1 AS i FROM posts),
rows0 AS (SELECT CAST(i % {t} AS VARCHAR) AS tree, '' AS code, f FROM numbered WHERE i < {t * s}),
down0 AS (SELECT source, post_id, CAST(range AS VARCHAR) AS tree, '' AS code, f FROM numbered, range({t})),""" + ",".join(steps) + f""",
scored AS (SELECT source, post_id, round(pow(2.0, -(sum(path) / {t}) / {OUT.average_path(s)}), 6) AS score FROM ({leaves}) GROUP BY source, post_id),
ranked AS (SELECT *, rank() OVER (ORDER BY score DESC) AS r, count(*) OVER () AS total FROM scored)
SELECT p.*, score, r <= ceil(0.01 * total) AS is_anomaly FROM posts p JOIN ranked USING (source, post_id)"""


def _topics_sql(k: int = 5, rounds: int = 10, terms: int = 8) -> str:
    """Expectation maximisation, round by round."""
    from ..functions import lexicon as L

    stop, ks = _list(L.phrase_stop_words()), range(k)
    shares = lambda of: ", ".join(f"(p{i} + {TOP.WORD_PRIOR}) / (sum(p{i}) OVER () + {TOP.WORD_PRIOR} * (SELECT count(*) FROM v)) AS p{i}" for i in ks)
    steps = []
    for r in range(rounds):
        s = " + ".join(f"t{i} * p{i}" for i in ks)
        total = " + ".join(f"sum(r{j})" for j in ks)
        steps.append(f"""
j{r} AS MATERIALIZED (SELECT doc_id, word, {", ".join(f"n * t{i} * p{i} / ({s}) AS r{i}" for i in ks)}
  FROM counts JOIN p{r} USING (word) JOIN d{r} USING (doc_id)),
p{r + 1} AS MATERIALIZED (SELECT word, {shares(None)} FROM (SELECT word, {", ".join(f"sum(r{i}) AS p{i}" for i in ks)} FROM j{r} GROUP BY word)),
d{r + 1} AS MATERIALIZED (SELECT doc_id, {", ".join(f"(sum(r{i}) + {TOP.DOC_PRIOR}) / ({total} + {TOP.DOC_PRIOR * k}) AS t{i}" for i in ks)}
  FROM j{r} GROUP BY doc_id)""")
    long = " UNION ALL ".join(f"SELECT {i} AS topic, word AS term, round(p{i}, 6) AS weight FROM p{rounds}" for i in ks)
    first = ", ".join(f"(CAST('0x' || substr(md5('{i}:' || word), 1, 7) AS BIGINT) + 1) / {1 << 28} AS p{i}" for i in ks)
    return f"""
WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
                                             lambda w: length(w) >= 3 AND NOT list_contains({stop}, w))) AS word FROM documents),
counts AS MATERIALIZED (SELECT doc_id, word, count(*) AS n FROM t GROUP BY doc_id, word),
v AS MATERIALIZED (SELECT DISTINCT word FROM t),
p0 AS MATERIALIZED (SELECT word, {shares(None)} FROM (SELECT word, {first} FROM v)),
d0 AS MATERIALIZED (SELECT DISTINCT doc_id, {", ".join(f"{1.0 / k} AS t{i}" for i in ks)} FROM counts),{",".join(steps)},
long AS ({long})
SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) - 1 AS rank, term, weight FROM long QUALIFY rank < {terms}"""


def _mentions_sql() -> str:
    tokens = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '')"

    def grams(key: str, table: str) -> str:
        words = f"SELECT {key}, {tokens} AS t FROM {table}"
        sizes = f"SELECT *, unnest([2, 3]) AS n FROM ({words})"
        places = f"SELECT *, unnest(generate_series(1, len(t) - n + 1)) AS i FROM ({sizes})"
        return f"SELECT {key}, i - 1 AS pos, list_aggregate(t[i:i + n - 1], 'string_agg', ' ') AS term FROM ({places})"

    return f"""
WITH v AS (SELECT DISTINCT term FROM ({grams("item_id", "benchmark")})),
g AS ({grams("doc_id", "documents")})
SELECT doc_id, term, count(*) AS mentions, min(pos) AS first_word FROM g JOIN v USING (term) GROUP BY doc_id, term"""


def _design_sql(days: int = 30) -> str:
    x = f"((epoch(hour) - epoch({_NOW} - INTERVAL {days} DAY)) / 86400)"
    columns = ["1.0 AS level", f"round({x}, 6) AS x"]
    for j in range(1, FC.CHANGE_POINTS + 1):
        at = days * FC.CHANGE_SHARE * j / (FC.CHANGE_POINTS + 1)
        columns += [f"round(greatest({x} - {at}::DOUBLE, 0.0), 6) AS bend{j}", f"CASE WHEN {x} >= {at}::DOUBLE THEN 1.0 ELSE 0.0 END AS jump{j}"]
    for name, span, pairs in (("day", 1, FC.DAILY), ("week", 7, FC.WEEKLY)):
        columns += [f"round({f}({x} * (2 * pi() * {k} / {span})), 6) + 0.0 AS {name}_{f}{k}" for k in range(1, pairs + 1) for f in ("sin", "cos")]
    return with_silver(_HOURLY_GRID + f"""
, future AS (SELECT source, unnest(generate_series({_NOW}, {_NOW} + INTERVAL 167 HOUR, INTERVAL 1 HOUR)) AS hour, NULL AS posts
             FROM (SELECT DISTINCT source FROM recent))
SELECT source, hour, CAST(posts AS DOUBLE) AS posts, {", ".join(columns)} FROM (SELECT * FROM h UNION ALL SELECT * FROM future)""")


def _bursts_sql(where: str = "") -> str:
    per = "PARTITION BY topic ORDER BY m"
    return with_silver(f"""
, mention AS (SELECT topic, CAST(floor(epoch(created_at) / 60) AS BIGINT) AS m FROM (
    SELECT created_at, unnest(list_distinct(CASE source WHEN 'twitter' THEN ['update', event_type] WHEN 'reddit' THEN ['thread', event_type]
                                            ELSE ['friends', event_type] END)) AS topic FROM silver))
, c AS (SELECT topic, m, count(*) AS n FROM mention GROUP BY topic, m)
, j AS (SELECT topic, m, sum(n) OVER ({per} RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS mentions,
               coalesce(sum(n) OVER ({per} RANGE BETWEEN 1499 PRECEDING AND 60 PRECEDING), 0) / 24 AS baseline FROM c)
, o AS (SELECT *, mentions >= 8 AND mentions > 1.5 * baseline AS on_ FROM j)
, a AS (SELECT *, coalesce(lag(on_) OVER ({per}) AND m - lag(m) OVER ({per}) < 60, false) AS going FROM o)
SELECT topic, make_timestamp(m * 60000000) AS minute, CAST(mentions AS BIGINT) AS mentions, round(baseline, 4) AS baseline
FROM a WHERE on_ AND NOT going{where}""")


def _tagged_sql() -> str:
    """Silver posts with the topics and the sentiment of their texts."""
    from .catalog import POST_NEGATIVE, POST_POSITIVE, POST_TOPICS

    topics, pos, neg = _list(POST_TOPICS), _list(POST_POSITIVE), _list(POST_NEGATIVE)
    return with_silver(f""",
worded AS (SELECT source, post_id, list_filter(regexp_split_to_array(lower(text_clean), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '') AS words
           FROM ({Q["clean_text"]})),
tagged AS (
  SELECT s.*, list_distinct(list_concat(
           list_filter({topics}, lambda k: contains(' ' || array_to_string(words, ' ') || ' ', ' ' || k || ' ')),
           list_transform(s.hashtags, lambda h: lower(h)))) AS topics,
         round((len(list_filter(words, lambda w: list_contains({pos}, w))) - len(list_filter(words, lambda w: list_contains({neg}, w))))
               / greatest(len(words), 1), 4) AS sentiment
  FROM silver s JOIN worded w ON w.source = s.source AND w.post_id = s.post_id)
""")


def _tagged_queries() -> dict[str, str]:
    """Queries over topics and sentiment, derived from the texts as the operators do."""
    stats = """
SELECT date_trunc('hour', created_at) AS hour, source, coalesce(community, '') AS community, count(*) AS post_count,
       round(avg(sentiment), 4) AS avg_sentiment, CAST(sum(engagement_score) AS BIGINT) AS total_engagement
FROM tagged GROUP BY ALL"""
    return {
        "hourly_stats": _tagged_sql() + stats,
        "gold_incremental": _tagged_sql() + stats,
        "hourly_keywords": _tagged_sql() + """
SELECT date_trunc('hour', created_at) AS hour, source, coalesce(community, '') AS community, keyword, count(*) AS mentions
FROM (SELECT *, unnest(topics) AS keyword FROM tagged) GROUP BY ALL""",
        "silver_write": _tagged_sql() + """
SELECT CAST(created_at AS DATE) AS partition_date, source, count(*) AS posts, round(avg(sentiment), 4) AS avg_sentiment
FROM tagged WHERE CAST(created_at AS DATE) >= DATE '2024-01-15' AND source <> 'twitter' GROUP BY ALL""",
    }


def _model_sql() -> dict[str, str]:
    return {**_tagged_queries(),
            "burst_alerts": _bursts_sql(),
            "stream_burst_alerts": _bursts_sql(" AND m + 1 <= (SELECT floor((epoch(max(created_at)) - 600) / 60) FROM silver)"),
            "forecast_design": _design_sql(), "new_only_filtered": Q["new_only_anti"],
            "lda_topics": _topics_sql(), "term_mentions": _mentions_sql(),
            "silver_features": "WITH " + SILVER + "," + _features_sql() + " SELECT * FROM posts", "unusual_posts": _forest_sql()}
Q["post_links"] = with_silver("""
SELECT source, post_id, CASE source WHEN 'reddit' THEN 'https://reddit.com/r/' || community || '/comments/' || post_id || '/'
  WHEN 'twitter' THEN 'https://twitter.com/' || author || '/status/' || post_id
  ELSE 'https://bsky.app/profile/' || author || '/post/' || post_id END AS link FROM silver""")
Q["share_labels"] = with_unified("""
SELECT source, format('{:,}', count(*)) AS posts_label,
       printf('%.1f%%', round(count(*) * 100.0 / sum(count(*)) OVER (), 4)) AS share_label FROM unified GROUP BY source""")
