"""Engagement formulas and small conditionals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Network code → display label (unknown codes are skipped).
SOURCE_LABELS = {"twitter": "Twitter", "reddit": "Reddit", "bluesky": "Bluesky"}
# Badge class per display label.
SOURCE_BADGES = {"Reddit": "badge-reddit", "Bluesky": "badge-bluesky", "Twitter": "badge-twitter"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def z(c) -> Column:
    """A missing metric counts as 0 (``strict`` callers skip this)."""
    return F.coalesce(_c(c).cast("bigint"), F.lit(0).cast("bigint"))


def engagement_score(source, likes, shares, replies, quotes, strict: bool = False) -> Column:
    """Silver score.

    twitter: 2·likes + 5·retweets + 3·replies + 4·quotes
    reddit:  score + 2·num_comments  (``likes`` = score, ``replies`` = comments)
    bluesky: same weights as twitter over likes/reposts/replies/quotes
    """
    f = (lambda c: _c(c).cast("bigint")) if strict else z
    tw = f(likes) * 2 + f(shares) * 5 + f(replies) * 3 + f(quotes) * 4
    rd = f(likes) + f(replies) * 2
    return F.when(_c(source) == "reddit", rd).otherwise(tw)


def engagement(source, likes, shares) -> Column:
    """Dashboard engagement (F24): likes + 2·retweets/reposts; Reddit: score."""
    return F.when(_c(source) == "reddit", z(likes)).otherwise(z(likes) + z(shares) * 2)


def source_label(source) -> Column:
    """Code → label; NULL for unknown codes (callers filter those out)."""
    m = F.create_map(*[F.lit(x) for kv in SOURCE_LABELS.items() for x in kv])
    return F.element_at(m, _c(source))


def badge_class(label) -> Column:
    """CSS class by source label, Twitter as the fallback."""
    return (F.when(_c(label) == "Reddit", F.lit(SOURCE_BADGES["Reddit"]))
            .when(_c(label) == "Bluesky", F.lit(SOURCE_BADGES["Bluesky"]))
            .otherwise(F.lit(SOURCE_BADGES["Twitter"])))
