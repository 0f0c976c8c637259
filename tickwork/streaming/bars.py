"""A1 on a stream: tumbling OHLCV bars with an event-time watermark.

Append mode: a bar is emitted once the watermark passes its end, and its
state is dropped then, so state stays bounded by the late-data allowance.
Ticks with equal times are ordered like in the batch operator (by the value, or
the ``tiebreak`` columns), so a bar doesn't depend on how they arrive.
The grouping uses the ``window`` struct itself (that is what carries the
event-time metadata the watermark needs); ``start`` is projected afterwards.
Row-frame indicators (lags, moving averages) are batch operators; run them on
the emitted bars (e.g. in ``foreachBatch`` or on the sink table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.functions.order import packed_order


def stream_bars(
    stream: DataFrame,
    *,
    ts: str = "ts_raw",
    keys: Sequence[str] = (),
    size: str = "1 hour",
    watermark: str = "1 hour",
    out_ts: str = "ts_hour",
    suffix: str = "_1h",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Bars ``*keys, out_ts, open, close, high, low, vol, volatility`` over a streaming frame of ticks."""
    ntz = dict(stream.dtypes).get(ts) == "timestamp_ntz"
    if ntz:  # watermarks need TIMESTAMP; wall clock is kept exactly in a zone without DST (e.g. UTC)
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    c = F.col("close").cast("double")
    first, last = (packed_order(stream, [ts, *(tiebreak or [v])]) for v in ("open", "close"))
    win = F.window(F.col(ts), size).alias("_tw_win")
    start = F.col("_tw_win.start")
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(*keys, win)
        .agg(
            F.min_by(F.col("open").cast("double"), first).alias(f"open{suffix}"),
            F.max_by(c, last).alias(f"close{suffix}"),
            F.max(F.col("high").cast("double")).alias(f"high{suffix}"),
            F.min(F.col("low").cast("double")).alias(f"low{suffix}"),
            F.sum(F.col("volume").cast("double")).alias(f"vol{suffix}"),
            F.stddev_pop(c).alias(f"volatility{suffix}"),
        )
        .select(*keys, (start.cast("timestamp_ntz") if ntz else start).alias(out_ts), f"open{suffix}", f"close{suffix}", f"high{suffix}",
                f"low{suffix}", f"vol{suffix}", f"volatility{suffix}")
    )
