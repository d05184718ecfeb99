"""Bronze layer: topic records → parsed envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import SOURCE_LABELS
from ..schemas import ENVELOPE_MAP


def decode(records: DataFrame) -> DataFrame:
    """Binary value → JSON text, topic coordinates kept for ordering."""
    cols = [F.col("value").cast("string").alias("json_value")]
    for c, alias in (("partition", "topic_partition"), ("offset", "topic_offset"),
                     ("timestamp", "topic_timestamp")):
        if c in records.columns:
            cols.append(F.col(c).alias(alias))
    return records.select(*cols)


def parse_envelope(decoded: DataFrame) -> DataFrame:
    """JSON → (source, event_timestamp, raw_data map). Nested values in
    ``data`` stay JSON text inside the map (quirk Q1)."""
    # The parse is wrapped in a one-element ``inline`` (a Generate node): a
    # later filter on a parsed field then stays above it. A plain projection
    # would let Catalyst push that filter below the parse and substitute the
    # whole from_json into it – parsing every envelope twice.
    env = F.from_json("json_value", ENVELOPE_MAP)
    parsed = decoded.select("*", F.inline(F.array(env)))
    return parsed.withColumnRenamed("timestamp", "event_timestamp").withColumnRenamed("data", "raw_data")


def bronze(records: DataFrame, processed_at: Column | None = None, observe: str | None = None) -> DataFrame:
    """The bronze table rows.

    ``observe`` names counts that are taken on the way (A19): records,
    parsed envelopes, and posts of a known network, as ``Dataset.observe``
    metrics of every batch.

    ``processed_at`` is the ingestion stamp (``current_timestamp()`` when
    omitted); tests pass the record time so the result is reproducible.
    ``partition_date`` is its date, as in the reference sink layout.
    Rows whose envelope does not parse are *kept out* (see ``split_bad``).
    """
    parsed = parse_envelope(decode(records))
    if observe:
        known = F.col("source").isin(list(SOURCE_LABELS))
        parsed = parsed.observe(observe, F.count(F.lit(1)).alias("records"), F.count("source").alias("parsed"),
                                F.count_if(F.coalesce(known, F.lit(False))).alias("known_source"))
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    out = (parsed.where(F.col("source").isNotNull())
           .withColumn("processed_at", stamp)
           .withColumn("partition_date", F.to_date("processed_at")))
    keep = ["source", "event_timestamp", "raw_data", "processed_at", "partition_date"]
    keep += [c for c in ("topic_partition", "topic_offset") if c in out.columns]
    return out.select(*keep)


def split_bad(records: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Quarantine rows – payload, reason and time – for envelopes that are
    malformed JSON, not an object, or lack a source (quirk Q32)."""
    parsed = parse_envelope(decode(records))
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    reason = (F.when(F.col("json_value").isNull(), F.lit("null payload"))
              .when(F.col("raw_data").isNull() & F.col("source").isNull(), F.lit("malformed envelope"))
              .when(F.col("source").isNull(), F.lit("missing source")))
    return (parsed.withColumn("error", reason).where(F.col("error").isNotNull())
            .select(F.col("json_value").alias("payload"), "error",
                    stamp.alias("quarantined_at"),
                    *[c for c in ("topic_partition", "topic_offset") if c in parsed.columns]))
