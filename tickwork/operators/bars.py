"""Tumbling OHLCV bars (A1): one row per series key and epoch-aligned bucket.

Open and close are taken by time, not by the row order a shuffle happens to
deliver, so a bar does not depend on the input partitioning. Equal times are
ordered by the ``tiebreak`` columns, or without any by the value itself (the
smallest opens, the largest closes). Time and tie-break are packed into one
number (see :func:`tickwork.functions.order.packed_order`): a fixed-width
aggregation buffer keeps ``min_by``/``max_by`` in a hash aggregate, where a struct
would make Spark sort all ticks before it aggregates them.

The aggregation is Spark's partial + final hash aggregate: ticks are combined
map-side, only one partial row per (key, bucket, task) is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwork.functions.order import packed_order
from tickwork.functions.time import bucket_start


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")  # one cast; Catalyst folds it into a double input


def _first_last(ticks: DataFrame, value: str, ts: str, tiebreak: Sequence[str]) -> tuple[Column, Column]:
    order = packed_order(ticks, [ts, *(tiebreak or [value])])
    return F.min_by(F.col(value), order), F.max_by(F.col(value), order)


def ohlcv_bars(
    ticks: DataFrame,
    *,
    ts: str = "ts_raw",
    keys: Sequence[str] = (),
    size: str = "1 hour",
    tiebreak: Sequence[str] = (),
    open: str = "open",
    high: str = "high",
    low: str = "low",
    close: str = "close",
    volume: str = "volume",
    out_ts: str = "ts_hour",
    suffix: str = "_1h",
) -> DataFrame:
    """Aggregate ticks or candles into bars.

    Output: ``*keys, out_ts, open, close, high, low, vol, volatility`` (names
    suffixed, ``volatility`` = population deviation of ``close`` in the bar;
    0.0 for a one-row bar). Rows with a NULL time are dropped by the bucketing.

    Buckets are Spark ``window`` buckets: aligned to the epoch. For
    ``TIMESTAMP_NTZ`` input that is wall-clock alignment; for ``TIMESTAMP``
    (instants) a ``"1 day"`` bar is a UTC day whatever the session zone.
    """
    keys = list(keys)
    first_open, _ = _first_last(ticks, open, ts, tiebreak)
    _, last_close = _first_last(ticks, close, ts, tiebreak)
    return (
        ticks.groupBy(*keys, bucket_start(ts, size).alias(out_ts))
        .agg(
            first_open.cast("double").alias(f"open{suffix}"),
            last_close.cast("double").alias(f"close{suffix}"),
            F.max(_dbl(high)).alias(f"high{suffix}"),
            F.min(_dbl(low)).alias(f"low{suffix}"),
            F.sum(_dbl(volume)).alias(f"vol{suffix}"),
            F.stddev_pop(_dbl(close)).alias(f"volatility{suffix}"),
        )
    )


def hourly_bars(ticks: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_raw", **kw) -> DataFrame:
    """1-hour bars with the source pipeline's column names."""
    return ohlcv_bars(ticks, ts=ts, keys=keys, size="1 hour", **kw)
