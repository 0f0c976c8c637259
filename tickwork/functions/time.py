"""Timestamp parsing, bucketing and formatting.

Every helper returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen. Bucketing always goes through ``window(...).start``
so that the price side and the activity side of a join use the very same,
epoch-aligned expression (a ``date_trunc`` on one side and a ``window`` on the
other disagree in half-hour time zones).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text layout of hour keys written by the activity producers.
HOUR_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

_EPOCH_NTZ = "1970-01-01 00:00:00"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column) -> Column:
    """Trim surrounding blanks, then parse text as a session-zone timestamp."""
    return F.to_timestamp(F.trim(_col(c)))


def bucket_start(c: str | Column, size: str = "1 hour") -> Column:
    """Start of the epoch-aligned tumbling bucket holding ``c`` (type kept: NTZ stays NTZ).

    Spark allows one ``window`` expression per operator; use the result in a
    projection or grouping, not twice in the same ``select``.
    """
    return F.window(_col(c), size).start


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}


def interval_seconds(size: str) -> int:
    """``'5 minutes'`` -> 300 (units second/minute/hour/day/week, singular or plural)."""
    num, unit = size.strip().split()
    return int(float(num) * _SECONDS[unit.lower().rstrip("s")])


def bucket_floor(c: str | Column, size: str = "1 hour", *, ntz: bool) -> Column:
    """:func:`bucket_start` as plain arithmetic: rows without a time stay, with a NULL bucket.

    Weeks begin on the epoch's weekday, as those of ``window`` do. ``ntz`` says whether ``c`` is a
    ``TIMESTAMP_NTZ`` column (wall clock) or a ``TIMESTAMP`` (instant).
    """
    step = interval_seconds(size)
    seconds = epoch_seconds_ntz(F.date_trunc("second", _col(c)).cast("timestamp_ntz")) if ntz else F.unix_seconds(_col(c))
    start = F.floor(seconds / F.lit(step)) * F.lit(step)
    return epoch_to_utc_ntz(start) if ntz else F.timestamp_seconds(start)


def truncate_hour(c: str | Column) -> Column:
    """Calendar truncation to the hour in the session zone (returns TIMESTAMP)."""
    return F.date_trunc("hour", _col(c))


def epoch_ntz() -> Column:
    """The epoch as a wall-clock literal."""
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz")


def epoch_to_utc_ntz(seconds: str | Column) -> Column:
    """Epoch seconds -> UTC wall-clock ``TIMESTAMP_NTZ``, independent of the session zone."""
    return F.timestamp_add("SECOND", _col(seconds), epoch_ntz())


def epoch_seconds_ntz(c: str | Column) -> Column:
    """Whole seconds since the epoch of a UTC wall-clock ``TIMESTAMP_NTZ`` (truncating)."""
    return F.timestamp_diff("SECOND", epoch_ntz(), _col(c))


def hour_text(c: str | Column) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(_col(c), HOUR_TEXT_FORMAT)
