"""Vector similarity (K6): class centroids and nearest members, exact. For
many queries see :mod:`.vector_index`.

Every vector is scored against the centroid of its own label only – an
equi-join on the label, so the work is linear in the corpus and no pair of
corpus vectors is ever formed. The centroid side is one row per label; AQE
broadcasts it when its measured size is under the broadcast threshold and
falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL for a zero vector (ANSI-safe division)."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def centroids(vectors: DataFrame, key: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean vector per key: explode positions, average per (key, position) with
    a partial aggregate, then re-assemble (dimension-sized lists only)."""
    exploded = vectors.select(key, F.posexplode(F.col(vec).cast("array<double>")).alias("pos", "x"))
    per_dim = exploded.groupBy(key, "pos").agg(F.avg("x").alias("x"))
    return (per_dim.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_p"))
            .select(key, F.transform("_p", lambda s: s["x"]).alias("centroid")))


def nearest_to_centroid(vectors: DataFrame, k: int = 5, key: str = "label", vec: str = "embedding",
                        id_col: str = "vec_id") -> DataFrame:
    """K6: the k vectors most similar (cosine) to their label's centroid.
    ``row_number() <= k`` is planned with a map-side group limit."""
    cents = centroids(vectors, key, vec)
    scored = (vectors.join(cents, key)
              .select(key, id_col, cosine(F.col(vec).cast("array<double>"), F.col("centroid")).alias("score")))
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc(id_col))
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
            .withColumn("score", F.round("score", 4)))
