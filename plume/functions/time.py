"""Date/time Column functions (F16–F21). Clock always passed in (``as_of``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of) -> Column:
    """A clock value: Column, ISO string or datetime → timestamp Column."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")


def parse_time(s) -> Column:
    """ISO strings (with ``Z``, an offset or none) or epochs (seconds,
    milliseconds or microseconds, told apart by their digits).

    ANSI mode raises on bad input for ``to_timestamp``; ``try_to_timestamp``
    gives NULL (Q30). Numeric strings are epoch seconds (Q25: UTC).
    """
    s = _c(s).cast("string")
    n = s.try_cast("double")
    # Up to 11 integer digits are seconds, 12 to 14 milliseconds, 15 to 17 microseconds.
    return (F.when(s.rlike(r"^\d{1,11}(\.\d+)?$"), F.timestamp_seconds(n))
            .when(s.rlike(r"^\d{12,14}(\.\d+)?$"), F.timestamp_seconds(n / 1000))
            .when(s.rlike(r"^\d{15,17}$"), F.timestamp_micros(s.try_cast("bigint")))
            .otherwise(F.try_to_timestamp(s)))


def format_time(ts, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """timestamp → string."""
    return F.date_format(_c(ts), fmt)


def age_seconds(ts, as_of) -> Column:
    """Whole seconds between ``ts`` and the clock, clamped at 0 (Q33)."""
    diff = F.unix_seconds(as_of_lit(as_of)) - F.unix_seconds(_c(ts).cast("timestamp"))
    return F.greatest(diff, F.lit(0))


def age_bucket(ts, as_of) -> Column:
    """relative age label: years > months > days > hours > minutes > now.

    Same thresholds as the dashboard (days > 365, > 30, > 0, then hours and
    minutes of the remainder); future times read as "just now" (Q33).
    """
    secs = age_seconds(ts, as_of)
    days = F.floor(secs / 86400)
    rem = secs - days * 86400
    return (
        F.when(_c(ts).isNull(), F.lit(None).cast("string"))
        .when(days > 365, F.format_string("%d years ago", F.floor(days / 365)))
        .when(days > 30, F.format_string("%d months ago", F.floor(days / 30)))
        .when(days > 0, F.format_string("%d days ago", days))
        .when(rem >= 3600, F.format_string("%d hours ago", F.floor(rem / 3600)))
        .when(rem >= 60, F.format_string("%d minutes ago", F.floor(rem / 60)))
        .otherwise(F.lit("just now"))
    )


def day_label(d, as_of) -> Column:
    """today / yesterday / n days ago (n ≤ 7) / yyyy-MM-dd."""
    today = F.to_date(as_of_lit(as_of))
    n = F.greatest(F.datediff(today, _c(d)), F.lit(0))
    return (
        F.when(_c(d).isNull(), F.lit(None).cast("string"))
        .when(n == 0, F.lit("today"))
        .when(n == 1, F.lit("yesterday"))
        .when(n <= 7, F.format_string("%d days ago", n))
        .otherwise(F.date_format(_c(d), "yyyy-MM-dd"))
    )


def to_ntz(ts) -> Column:
    """Output timestamps as wall-clock (NTZ) values, zone-free for sinks/oracles."""
    return _c(ts).cast("timestamp_ntz")
