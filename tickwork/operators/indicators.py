"""Row-frame indicators over time-ordered bars.

Frames count *rows*, not time: ``lag 1`` is the previous bar even across a
gap, and leading frames are partial (the 12-bar average of the first bar is its
own close). ``stddev`` is the sample deviation, NULL over a single row.

All indicators of one call are evaluated in a single layout pass
(:func:`tickwork.operators.series.with_series_columns`), in one projection
over the input columns: one ``Window`` operator, one partitioning, one sort.
A lagged return is therefore written over the closes directly,
``ret_lag_k = ln(lag(close, k) / lag(close, k + 1))`` -- the same value, NULLs
included, as ``lag(ret, k)``, without a second window pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.functions.returns import log_return, ratio
from tickwork.operators.series import ColumnBuilder, Layout, layout_for_bar_size, with_series_columns


def _lagged_log_return(close: str, k: int, on_zero: str) -> ColumnBuilder:
    """``ln(close[t-k] / close[t-k-1])``; k = 0 is the return itself."""
    cur = (lambda s: F.lag(close, k).over(s.rows)) if k else (lambda s: F.col(close))
    return lambda s: log_return(cur(s), F.lag(close, k + 1).over(s.rows), on_zero)


def return_specs(close: str, ret: str, on_zero: str = "error") -> list[tuple[str, ColumnBuilder]]:
    return [(ret, _lagged_log_return(close, 0, on_zero))]


def lag_specs(ret: str, lags: Sequence[int], close: str = "close_1h",
              on_zero: str = "error") -> list[tuple[str, ColumnBuilder]]:
    return [(f"{ret}_lag{k}", _lagged_log_return(close, k, on_zero)) for k in lags]


def _frame(s, n: int, frame: str, step: int):
    """The last ``n`` rows (row frame) or the last ``n`` bar intervals of ``step`` seconds (time frame)."""
    if frame == "rows":
        return s.rows.rowsBetween(-(n - 1), 0)
    if frame == "time":
        return s.time.rangeBetween(-(n - 1) * step, 0)
    raise ValueError(f"frame must be 'rows' or 'time', not {frame!r}")


def ma_specs(close: str, windows: Sequence[int], unit: str, frame: str = "rows",
             step: int = 3600) -> list[tuple[str, ColumnBuilder]]:
    return [
        (f"ma_close_{n}{unit}", (lambda n: lambda s: F.avg(close).over(_frame(s, n, frame, step)))(n))
        for n in windows
    ]


def vol_spec(close: str, n: int, unit: str, frame: str = "rows", step: int = 3600) -> list[tuple[str, ColumnBuilder]]:
    return [(f"vol_{n}{unit}", lambda s: F.stddev_samp(close).over(_frame(s, n, frame, step)))]


def frame_reach(longest: int, frame: str, step: int) -> dict[str, int]:
    """How far frames of up to ``longest`` bars reach back: rows, or seconds whatever the bar size."""
    return {"back": longest - 1} if frame == "rows" else {"back_seconds": (longest - 1) * step}


def _run(df, specs, keys, ts, reach, layout, size):
    return with_series_columns(df, specs, keys=keys, order=ts, layout=layout or layout_for_bar_size(size), **reach)


def log_returns(
    bars: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_hour", close: str = "close_1h",
    ret: str = "ret_1h", on_zero: str = "error", size: str = "1 hour", layout: Layout | None = None,
) -> DataFrame:
    """W1 + P8: ``ret = ln(close / lag(close, 1))``; ``size`` is the bar size (it sets the default layout)."""
    return _run(bars, return_specs(close, ret, on_zero), keys, ts, {"back": 1}, layout, size)


def lagged_returns(
    bars: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_hour", close: str = "close_1h",
    ret: str = "ret_1h", lags: Sequence[int] = (1, 2), on_zero: str = "error", size: str = "1 hour",
    layout: Layout | None = None,
) -> DataFrame:
    """The return and its lags ``{ret}_lag{k}``."""
    specs = return_specs(close, ret, on_zero) + lag_specs(ret, lags, close, on_zero)
    return _run(bars, specs, keys, ts, {"back": max(lags, default=0) + 1}, layout, size)


def moving_averages(
    bars: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_hour", close: str = "close_1h",
    windows: Sequence[int] = (3, 12), unit: str = "h", frame: str = "rows", step: int = 3600,
    size: str = "1 hour", layout: Layout | None = None,
) -> DataFrame:
    """``ma_close_{n}{unit}`` = average close over the current and n-1 previous rows.

    ``frame="time"`` averages over the bars of the last n intervals of ``step``
    seconds instead (a gap then shortens the frame instead of reaching further
    back). ``step`` need not be the bar size.
    """
    reach = frame_reach(max(windows), frame, step)
    return _run(bars, ma_specs(close, windows, unit, frame, step), keys, ts, reach, layout, size)


def rolling_volatility(
    bars: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_hour", close: str = "close_1h",
    window: int = 24, unit: str = "h", frame: str = "rows", step: int = 3600, size: str = "1 hour",
    layout: Layout | None = None,
) -> DataFrame:
    """``vol_{n}{unit}`` = sample deviation of close over the current and n-1 previous rows
    (or, with ``frame="time"``, over the bars of the last n intervals of ``step`` seconds)."""
    reach = frame_reach(window, frame, step)
    return _run(bars, vol_spec(close, window, unit, frame, step), keys, ts, reach, layout, size)


def high_low_ratio(bars: DataFrame, *, high: str = "high_1h", low: str = "low_1h",
                   name: str = "high_low_ratio", on_zero: str = "error") -> DataFrame:
    """``high / low`` (a projection, no window)."""
    return bars.withColumn(name, ratio(high, low, on_zero))


def indicator_specs(
    close: str = "close_1h", high: str = "high_1h", low: str = "low_1h", ret: str = "ret_1h",
    ma: Sequence[int] = (3, 12), vol_window: int = 24, lags: Sequence[int] = (1, 2), unit: str = "h",
    frame: str = "rows", step: int = 3600, on_zero: str = "error",
) -> tuple[list[tuple[str, ColumnBuilder]], dict[str, int]]:
    """The W9 indicator set as ordered specs, and how far they reach (frames: see ``moving_averages``)."""
    specs = (
        return_specs(close, ret, on_zero)
        + [("high_low_ratio", lambda s: ratio(high, low, on_zero))]
        + lag_specs(ret, lags, close, on_zero)
        + ma_specs(close, ma, unit, frame, step)
        + vol_spec(close, vol_window, unit, frame, step)
    )
    reach = frame_reach(max([*ma, vol_window]), frame, step)
    reach["back"] = max(reach.get("back", 0), max(lags, default=0) + 1)
    return specs, reach


def add_indicators(
    bars: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_hour", close: str = "close_1h",
    high: str = "high_1h", low: str = "low_1h", ret: str = "ret_1h", ma: Sequence[int] = (3, 12),
    vol_window: int = 24, lags: Sequence[int] = (1, 2), unit: str = "h", frame: str = "rows", step: int = 3600,
    on_zero: str = "error", size: str = "1 hour", layout: Layout | None = None,
) -> DataFrame:
    """``ret_1h, high_low_ratio, ret_1h_lag1, ret_1h_lag2, ma_close_3h, ma_close_12h, vol_24h``.

    Row frames by default (the source pipeline's semantics); ``frame="time"``
    switches the averages and the deviation to time frames of ``step`` seconds.
    """
    specs, reach = indicator_specs(close, high, low, ret, ma, vol_window, lags, unit, frame, step, on_zero)
    return _run(bars, specs, keys, ts, reach, layout, size)
