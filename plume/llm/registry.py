"""Queries of the training-data operators: each applies one operator, with
production parameters, to its whole table. ``ORACLE_SQL`` holds DuckDB SQL
where SQL expresses the result; the others are tested against brute force in
``tests/llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plume.llm import decontaminate, grid_join, importance, jaccard_join, license_scan, line_dedup, link_trust, piece_lattice, \
    quality_rules, token_output, turn_repair, warc, word_runs
from plume.llm.common import stored, table


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_output.write_archive(table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_archive(spark, path)


def op2_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), ("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("long").alias("n_chars_left"),
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op8_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(table(spark, sf_dir, "pages"))
    records = stored(warc.read_records(spark, path, payloads=False), "records")  # the archives are parsed once
    return warc.resolve_revisits(warc.assemble(records))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.report(turn_repair.repair(turn_repair.damage(conversations)), conversations)


def op12_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_copies(table(spark, sf_dir, "embeddings"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.find_runs(word_runs.repeat_tails(table(spark, sf_dir, "documents")))
    # Of the longest runs the first, of those that with the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return out.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
                      (-F.col("best.shorter")).alias("period"),
                      F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
                      F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_token_output,
    op2_piece_lattice,
    op3_decontaminate,
    op4_link_trust,
    op5_jaccard_join,
    op6_quality_rules,
    op7_line_dedup,
    op8_importance,
    op9_license_scan,
    op10_warc,
    op11_turn_repair,
    op12_grid_join,
    op13_word_runs,
)}

ORACLE_SQL: dict[str, str] = {
    "op4_link_trust": r"""
WITH RECURSIVE addresses AS (
    SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id, html,
           translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM addresses),
rules(rule, verdict, rule_host, rule_path) AS (VALUES
    ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
    ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'),
    ('net/fr/', 'block', 'net', '/fr/')),
fitting AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS rule_verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id),
judged AS (SELECT p.page_id, host, path, rule, rule_verdict FROM parts p LEFT JOIN fitting f ON p.page_id = f.page_id),
links AS (
    SELECT host AS source, unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\s*=\s*["'']?\s*([^"''\s<>]+)', 1)) AS link FROM parts),
targets AS (
    SELECT source, CASE WHEN regexp_matches(link, '^(?i)([a-z][a-z0-9+.-]*:)?//') THEN
        translate(regexp_extract(substr(link, strpos(link, '//') + 2), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        WHEN NOT regexp_matches(link, '^(?i)(#|[a-z][a-z0-9+.-]*:)') THEN source END AS target
    FROM links),
edges AS (SELECT source, target, count(*) AS links FROM targets WHERE source <> '' AND target <> '' GROUP BY ALL),
own AS (
    SELECT host, count(*) AS pages, CAST(count(*) FILTER (WHERE rule_verdict = 'allow') AS DOUBLE) AS trust,
           CAST(count(*) FILTER (WHERE rule_verdict = 'block') AS DOUBLE) AS distrust
    FROM judged WHERE host <> '' GROUP BY host),
steps AS MATERIALIZED (
    SELECT 'trust' AS kind, source AS from_host, target AS to_host, links / sum(links) OVER (PARTITION BY source) AS p FROM edges
    UNION ALL
    SELECT 'distrust', target, source, links / sum(links) OVER (PARTITION BY target) FROM edges),
hosts AS (SELECT host FROM own UNION SELECT target FROM edges),
every AS MATERIALIZED (
    SELECT * FROM steps
    UNION ALL
    SELECT kind, host, host, 1.0 FROM hosts, (VALUES ('trust'), ('distrust')) k(kind)
    WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.kind = k.kind AND s.from_host = hosts.host)),
seeds AS MATERIALIZED (
    SELECT 'trust' AS kind, host, trust AS score FROM own WHERE trust > 0
    UNION ALL SELECT 'distrust', host, distrust FROM own WHERE distrust > 0),
scores AS (
    SELECT 0 AS step, kind, host, score FROM seeds
    UNION ALL
    SELECT step, kind, host, sum(score) FROM (
        SELECT s.step + 1 AS step, e.kind, e.to_host AS host, 0.85 * s.score * e.p AS score
        FROM scores s JOIN every e ON s.kind = e.kind AND s.host = e.from_host WHERE s.step < 60
        UNION ALL
        SELECT b.step + 1, seeds.kind, seeds.host, 0.15 * seeds.score
        FROM seeds, (SELECT DISTINCT step FROM scores WHERE step < 60) b)
    GROUP BY ALL),
totals AS (
    SELECT host, sum(CASE WHEN kind = 'trust' THEN score ELSE 0 END) AS trust,
           sum(CASE WHEN kind = 'distrust' THEN score ELSE 0 END) AS distrust
    FROM scores WHERE step = 60 GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(rule_verdict, CASE WHEN t.distrust > t.trust AND (o.distrust >= 0.5 * pages OR
           t.distrust * (1 - 0.85 * coalesce(p, 0)) - 0.15 * o.distrust >= 0.05 * pages) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN totals t ON j.host = t.host LEFT JOIN own o ON j.host = o.host
LEFT JOIN every e ON j.host = e.from_host AND e.kind = 'distrust' AND e.to_host = e.from_host""",
    "op5_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN list_aggregate(w, 'string_agg', ' ')
        ELSE list_aggregate(w[i:i + 4], 'string_agg', ' ') END AS shingle
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON reach.other = both_ways.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op10_warc": """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
h AS (SELECT payload_digest, min(page_id) AS head FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN h.head <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN h.head <> p.page_id THEN h.head END AS refers_to
FROM p LEFT JOIN h USING (payload_digest)""",
    "op12_grid_join": """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
    SELECT i, e, sqrt(list_inner_product(e, e)) AS norm FROM v
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
links AS (
    SELECT a.i AS x, b.i AS y FROM good a JOIN good b ON a.i < b.i AND len(a.e) = len(b.e)
    WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT i, i AS other FROM v UNION SELECT reach.i, both_ways.y FROM reach JOIN both_ways ON reach.other = both_ways.x),
least AS (SELECT reach.i, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.other = v.i GROUP BY reach.i),
n AS (SELECT x AS i, count(*) AS n FROM both_ways GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id IS NOT DISTINCT FROM coalesce(component_id, vec_id) AS kept
FROM v JOIN least USING (i) LEFT JOIN n USING (i)""",
}
