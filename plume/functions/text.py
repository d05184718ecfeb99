"""String Column functions (F1–F15). All JVM-side, no Python in the hot path."""

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character the same way in Spark (Java), DuckDB (RE2) and Python:
# Java's \w is ASCII-only, so spell the Unicode class out.
WORD = r"[\p{L}\p{N}_]"

# Blanks as Python's text functions see them: Java's \s is ASCII only, which
# would let an address run on through an ideographic space and its text.
BLANK = r"\s\x0B\x1C-\x1F\x85\p{Z}"
SOLID = rf"[^{BLANK}]"

# URL patterns removed before any text analysis.
URL_PATTERN = rf"http{SOLID}+|www{SOLID}+"
# Twitter cleaning also drops mentions and the '#' character.
TWITTER_CLEAN_PATTERN = rf"http{SOLID}+|www{SOLID}+|@{SOLID}+|#"

# The entities that the short form decodes. ``&amp;``
# must come last so that ``&amp;lt;`` decodes once, to ``&lt;``.
HTML_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
    ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "·"), ("&copy;", "©"),
    ("&reg;", "®"), ("&hellip;", "…"), ("&mdash;", "—"), ("&ndash;", "–"),
    ("&amp;", "&"),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_twitter(text) -> Column:
    """lower, drop URLs, mentions and the '#' character; blanks are kept."""
    return F.regexp_replace(F.lower(_c(text)), TWITTER_CLEAN_PATTERN, "")


def clean_reddit(text) -> Column:
    """lower and drop URLs only."""
    return F.regexp_replace(F.lower(_c(text)), URL_PATTERN, "")


# Code points that browsers read as Windows-1252, and those that a numeric entity gives nothing for.
_C1 = {str(n): ord(bytes([n]).decode("cp1252")) for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
_NONE = [*range(1, 9), 0x0B, *range(0x0E, 0x20), 0x7F, *range(0xFDD0, 0xFDF0), *[p << 16 | n for p in range(17) for n in (0xFFFE, 0xFFFF)]]


def _constant(value, schema: str) -> Column:
    """A table as one literal: folded once a query."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _character(n: Column) -> Column:
    """The character of a numeric entity."""
    fixed = F.coalesce(F.try_element_at(_constant(_C1, "map<string,bigint>"), n.cast("string")), n)
    char = F.decode(F.unhex(F.lpad(F.hex(fixed), 8, "0")), "UTF-32")
    bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    return F.when(bad, "\uFFFD").when(n.isin(_NONE), "").otherwise(char)


def _entity(p: Column) -> Column:
    """What stands behind an ``&``, with the entity decoded that it begins with, or the ``&`` again."""
    names = html.entities.html5
    digits = lambda pattern: F.substring(F.regexp_replace(F.regexp_extract(p, pattern, 1), "^0+", ""), 1, 8)
    number = F.when(p.rlike("^#[xX]"), F.conv(F.concat(F.lit("0"), digits("^#[xX]([0-9a-fA-F]+)")), 16, 10)) \
        .otherwise(F.concat(F.lit("0"), digits("^#([0-9]+)"))).cast("bigint")
    numeric = F.concat(F.element_at(F.transform(F.array(number), _character), 1),
                       F.regexp_replace(p, "^#([xX][0-9a-fA-F]+|[0-9]+);?", ""))
    whole = _constant({k: v for k, v in names.items() if k.endswith(";")}, "map<string,string>")
    bare = _constant([{"k": k, "v": v} for k, v in sorted(names.items(), key=lambda e: -len(e[0])) if not k.endswith(";")],
                     "array<struct<k:string,v:string>>")  # names that need no semicolon: the longest one that fits
    name = F.regexp_extract(p, "^[^\\t\\n\\f <&#;]{1,32};", 0)
    exact = F.try_element_at(whole, name)
    fits = F.filter(bare, lambda e: F.startswith(p, e["k"]))
    prefix = F.element_at(F.transform(F.array(fits), lambda f: F.when(
        F.size(f) > 0, F.concat(F.get(f, 0)["v"], F.substr(p, F.length(F.get(f, 0)["k"]) + 1))).otherwise(F.concat(F.lit("&"), p))), 1)
    named = F.when(exact.isNotNull(), F.concat(exact, F.substr(p, F.length(name) + 1))).otherwise(prefix)
    return F.when(p.rlike("^#([xX][0-9a-fA-F]|[0-9])"), numeric).otherwise(named)


def html_unescape(text, full: bool = True) -> Column:
    """decode HTML entities, named and numeric, the complete HTML5 set, as ``html.unescape`` does, in the JVM. A text
    without ``&`` costs one search; of others each part behind an ``&`` is looked at once. ``full=False`` decodes only
    the named entities listed above."""
    if not full:
        out = _c(text)
        for ent, ch in HTML_ENTITIES:
            out = F.replace(out, F.lit(ent), F.lit(ch))
        return out

    def whole(x: Column) -> Column:
        parts = F.split(x, "&")
        decoded = F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), _entity), "")
        return F.when(F.contains(x, F.lit("&")), F.concat(F.get(parts, 0), decoded)).otherwise(x)

    # Bound to a lambda variable, so that a long text expression is evaluated once.
    return F.element_at(F.transform(F.array(_c(text)), whole), 1)


def strip_tags(text) -> Column:
    """remove anything that looks like a tag."""
    return F.regexp_replace(_c(text), r"<[^>]+>", "")


def collapse_ws(text) -> Column:
    """runs of blanks (Unicode ones too) to one space, trimmed."""
    return F.trim(F.regexp_replace(_c(text), rf"[{BLANK}]+", " "))


def clean_html(text, full: bool = True) -> Column:
    """F5–F7 in the reference order: unescape, strip tags, collapse blanks."""
    return collapse_ws(strip_tags(html_unescape(text, full)))


def clean_plain(text) -> Column:
    """Bluesky path: unescape and collapse, no tag strip."""
    return collapse_ws(html_unescape(text))


def snippet(text, n: int = 200) -> Column:
    """F8: first n characters + '...'."""
    return F.concat(F.substring(_c(text), 1, n), F.lit("..."))


def drop_punct(text) -> Column:
    """every non-word, non-blank character becomes a blank."""
    return F.regexp_replace(_c(text), rf"[^\p{{L}}\p{{N}}_{BLANK}]", " ")


def extract_hashtags(text) -> Column:
    """``#word`` → word (array, text order)."""
    return F.regexp_extract_all(_c(text), F.lit(r"#([\p{L}\p{N}_]+)"), 1)


def extract_mentions(text) -> Column:
    """``@name.with.dots`` → name (array, text order)."""
    return F.regexp_extract_all(_c(text), F.lit(r"@([\p{L}\p{N}_.]+)"), 1)


def tokens(text) -> Column:
    """blank-separated tokens, empty pieces removed."""
    return F.filter(F.split(F.trim(_c(text)), r"\s+"), lambda w: F.length(w) > 0)


def uri_tail(uri) -> Column:
    """last path part of a URI."""
    return F.element_at(F.split(_c(uri), "/"), -1)


def thousands(x) -> Column:
    """1234567 → '1,234,567'."""
    return F.format_number(_c(x), 0)


def percent1(x) -> Column:
    """12.345 → '12.3%'."""
    return F.format_string("%.1f%%", _c(x))


def permalink(source, community, author, post_id) -> Column:
    """a post's public address: ``https://reddit.com`` and its path in the community, or the network's own form."""
    src, who, key = _c(source), _c(author), _c(post_id)
    return (F.when(src == "reddit", F.concat(F.lit("https://reddit.com/r/"), _c(community), F.lit("/comments/"), key, F.lit("/")))
            .when(src == "twitter", F.concat(F.lit("https://twitter.com/"), who, F.lit("/status/"), key))
            .when(src == "bluesky", F.concat(F.lit("https://bsky.app/profile/"), who, F.lit("/post/"), key)))
