"""Already-seen filter that does not shuffle history.

Seen posts leave bits in a table of fixed size: HASHES bits of ``2 ** BITS`` per
network, stored as 64-bit words that merge by OR. Every epoch of seen posts
writes its own words, so a replay changes nothing; :func:`merged` adds epochs
up, and its size is bounded by the table's, not by the history.

New posts meet the words by an equi-join of their few bit positions. A post
with a bit missing was never seen; that is certain. The others are looked up in
the history itself: they are few (posts seen before, and a small share of false
hits), so they are the side that is broadcast and the history is only scanned.
The result is exact: no new post is dropped, no seen one is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace

KEYS = ["source", "post_id"]
#: Bits of the table of one network, as a power of two, and bits that a post sets. 2**30 bits hold 100 million posts at
#: two false hits in a thousand.
BITS = 30
HASHES = 4


def _positions() -> Column:
    return F.array(*[F.pmod(F.xxhash64("post_id", F.lit(k)), F.lit(1 << BITS)) for k in range(HASHES)])


def seen_words(posts: DataFrame) -> DataFrame:
    """(source, word, bits) of the posts; those without an id leave none."""
    at = posts.where(F.col("post_id").isNotNull()).select("source", F.explode(_positions()).alias("at"))
    return at.groupBy("source", F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits"))


def merged(words: DataFrame) -> DataFrame:
    """The words of several epochs as one table."""
    return words.groupBy("source", "word").agg(F.bit_or("bits").alias("bits"))


def remember(posts: DataFrame, epoch_id: int, path: str) -> None:
    """Store the words of one epoch of seen posts; a replayed epoch writes the same ones again."""
    seen_words(posts).withColumn("epoch", F.lit(epoch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path)


def unseen(new: DataFrame, words: DataFrame, history: DataFrame) -> DataFrame:
    """The rows of ``new`` whose (source, post_id) the history does not hold; rows with a null key are new. ``words``:
    of all posts of the history, merged."""
    space = Workspace(new.sparkSession, "seen")
    ids = space.put(new.select(*KEYS).where("source IS NOT NULL AND post_id IS NOT NULL").distinct())
    at = ids.select(*KEYS, F.explode(_positions()).alias("at")).withColumn("word", F.shiftright("at", 6))
    # The words that are asked for are at most HASHES times the new ids.
    asked = space.put(at.select("source", "word").distinct())
    known = words.join(F.broadcast(asked) if asked.count() <= 1 << 20 else asked, ["source", "word"], "left_semi")
    hit = F.expr("coalesce((shiftrightunsigned(bits, cast(at & 63 AS int)) & 1L) = 1L, false)")
    maybe = space.put(at.join(known, ["source", "word"], "left").groupBy(*KEYS).agg(F.bool_and(hit).alias("hit")).where("hit").select(*KEYS))
    few = maybe.count() <= 1 << 20  # as many ids are broadcast at most; beyond, the join is shuffled
    held = history.select(*KEYS).join(F.broadcast(maybe) if few else maybe, KEYS, "left_semi").distinct()
    return new.join(space.put(held), KEYS, "left_anti")
