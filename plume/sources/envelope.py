"""Envelope builder (S5) and topic-record shaping (S6 input)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def envelope_json(source, data: Column, timestamp) -> Column:
    """``{"source":…, "timestamp":…, "data":{…}}`` as one JSON string."""
    src = F.col(source) if isinstance(source, str) else source
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.to_json(F.struct(src.alias("source"), ts.alias("timestamp"), data.alias("data")))
