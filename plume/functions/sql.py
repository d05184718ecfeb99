"""The text functions as SQL functions (``CREATE TEMPORARY
FUNCTION … RETURN <expr>``). The bodies are Spark SQL expressions, so a SQL
user gets the same JVM-side code as the Column API: no Python worker."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import lexicon as L
from .text import BLANK, HTML_ENTITIES, URL_PATTERN


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _among(words) -> str:
    """``w IN (...)``: one hash look-up a word."""
    return "w IN (" + ", ".join(_lit(w) for w in words) + ")"


def _with_tokens(x: str, body: str) -> str:
    """``body`` over ``t``, the word tokens of x, which are made once."""
    return f"element_at(transform(array({_tokens(x)}), t -> {body}), 1)"


def clean_html_sql(x: str = "x") -> str:
    out = x
    for ent, ch in HTML_ENTITIES:
        out = f"replace({out}, {_lit(ent)}, {_lit(ch)})"
    out = f"regexp_replace({out}, {_lit('<[^>]+>')}, '')"
    return f"trim(regexp_replace({out}, {_lit(rf'[{BLANK}]+')}, ' '))"


def _tokens(x: str) -> str:
    return f"filter(split(lower({x}), {_lit(r'[^\p{L}\p{N}_]+')}), w -> w != '')"


def keywords_sql(x: str = "x") -> str:
    """K1's single-word keywords of one text (the fallback rule)."""
    toks = (f"filter(split(trim(lower(regexp_replace(regexp_replace({x}, {_lit(URL_PATTERN)}, ''), "
            f"{_lit(rf'[^\p{{L}}\p{{N}}_{BLANK}]')}, ' '))), {_lit(rf'[{BLANK}]+')}), w -> w != '')")
    return (f"filter({toks}, w -> length(w) >= 4 AND NOT {_among(L.phrase_stop_words())} "
            f"AND NOT {_among(L.GENERIC_WORDS)} AND w RLIKE {_lit(r'^\p{L}+$')} AND NOT startswith(w, 'ai'))")


def phrases_sql(x: str = "x") -> str:
    """K1's phrases of one text, in order: two to four words of a sentence part, as ``operators.text`` counts them."""
    words = (f"filter(split(trim(lower(regexp_replace(s, {_lit(rf'[^\p{{L}}\p{{N}}_{BLANK}]')}, ' '))), {_lit(rf'[{BLANK}]+')}), w -> w != '')")
    # Every word is judged once: m has null for a stop word or number, y for a generic one too; a null makes a phrase null.
    judged = f"transform({words}, w -> CASE WHEN NOT ({_among(L.phrase_stop_words())} OR w RLIKE {_lit(r'^\p{Nd}+$')}) THEN w END)"
    ends = f"transform(m, w -> CASE WHEN NOT {_among(L.GENERIC_WORDS)} THEN w END)"
    grams = [", ' ', ".join(["w", *[f"get({'m' if j < n - 1 else 'y'}, i + {j})" for j in range(1, n)]]) for n in (2, 3, 4)]
    each = ", ".join(f"transform(y, (w, i) -> CASE WHEN w IS NOT NULL THEN concat({g}) END)" for g in grams)
    of_part = f"element_at(transform(array({ends}), y -> flatten(array({each}))), 1)"
    parts = f"split(regexp_replace({x}, {_lit(URL_PATTERN)}, ''), {_lit('[.!?;:]+|' + chr(92) + 'n')})"
    every = f"flatten(transform({parts}, s -> element_at(transform(array({judged}), m -> {of_part}), 1)))"
    excluded = "g IN (" + ", ".join(_lit(w) for w in L.EXCLUDED_PHRASES) + ")"
    return f"filter({every}, g -> g IS NOT NULL AND length(g) >= 8 AND NOT {excluded})"


def sentiment_sql(x: str = "x") -> str:
    hits = lambda words: f"size(filter(t, w -> {_among(words)}))"
    return _with_tokens(x, f"round(CASE WHEN size(t) > 0 THEN ({hits(L.POSITIVE_WORDS)} - {hits(L.NEGATIVE_WORDS)})"
                           f" / size(t) ELSE 0.0 END, 4)")


def language_sql(x: str = "x") -> str:
    # Most stop words first, then the order of the list.
    votes = ", ".join(f"named_struct('n', -size(filter(t, w -> {_among(L.stop_words(name))})), 'i', {i}, 'code', '{code}')"
                      for i, (code, name) in enumerate(L.LANGUAGES.items()))
    best = _with_tokens(x, f"transform(array(array_min(array({votes}))), v -> CASE WHEN v.n < 0 THEN v.code END)[0]")
    c = f"coalesce({x}, '')"
    cjk = f"length(regexp_replace({c}, {_lit(r'[^\p{IsHan}]')}, ''))"
    return f"CASE WHEN length({c}) > 0 AND {cjk} * 3 > length({c}) THEN 'zh' ELSE coalesce({best}, 'und') END"


FUNCTIONS = {
    "clean_html": ("STRING", clean_html_sql),
    "extract_keywords": ("ARRAY<STRING>", keywords_sql),
    "extract_phrases": ("ARRAY<STRING>", phrases_sql),
    "sentiment_score": ("DOUBLE", sentiment_sql),
    "detect_language": ("STRING", language_sql),
}


def register(spark: SparkSession, prefix: str = "plume_") -> list[str]:
    """Create the SQL functions for this session; returns their names."""
    names = []
    for name, (rtype, body) in FUNCTIONS.items():
        fn = f"{prefix}{name}"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {fn}(x STRING) RETURNS {rtype} RETURN {body('x')}")
        names.append(fn)
    return names
