"""The labelled feature table -- bars -> indicators -> activity join -> labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tickwork.functions.time import bucket_floor, interval_seconds
from tickwork.operators.bars import ohlcv_bars
from tickwork.operators.enrich import join_activity
from tickwork.operators.indicators import indicator_specs
from tickwork.operators.labels import DEFAULT_HORIZON, DEFAULT_THRESHOLD, finish_labels, future_spec
from tickwork.operators.series import Layout, layout_for_bar_size, with_series_columns

BAR_NAMES = ("open", "close", "high", "low", "vol", "volatility")
LABEL_COLUMNS = ("close_future", "return_future", "label_up")
# Moving averages, deviation window and lags of the source pipeline, in bars.
MA, VOL_WINDOW, LAGS = (3, 12), 24, (1, 2)
_HOUR = "_tw_hour"


def size_suffix(size: str) -> tuple[str, str]:
    """Column suffix of bars of a size, and of windows counted in them: hours ``_1h`` / ``h``, 15 minutes ``_15m`` / ``x15m``."""
    n, unit = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", size.lower()).groups()
    return f"_{n}{unit[0]}", unit[0] if n == "1" else f"x{n}{unit[0]}"


def build_features(
    prices: DataFrame,
    activity: DataFrame | None = None,
    *,
    keys: Sequence[str] = (),
    ts: str = "ts_raw",
    size: str = "1 hour",
    tiebreak: Sequence[str] = (),
    horizon: int = DEFAULT_HORIZON,
    threshold: float = DEFAULT_THRESHOLD,
    use_activity: bool = True,
    activity_columns: Sequence[str] | None = None,
    on_zero: str = "error",
    layout: Layout | None = None,
) -> DataFrame:
    """Labelled feature table: ``*keys, ts_hour``, bars, indicators, activity columns, labels.

    Column names follow the bar ``size`` (:func:`size_suffix`): ``close_1h``, ``ma_close_3h`` for hours, ``close_15m``,
    ``ma_close_3x15m`` for 15 minutes. ``ts_hour`` is the start of the bar; hourly activity meets every bar that begins
    in its hour.

    The indicators and the future close are computed in one ordered pass over
    the bars (one ``Window`` operator: one partitioning, one sort), *before* the activity join: a right
    side with duplicate hours can then not make a bar its own "future". The
    join keeps every bar; rows without a future are dropped last. ``on_zero``: see
    :func:`tickwork.functions.returns.ratio`.
    """
    keys = list(keys)
    layout = layout or layout_for_bar_size(size)
    suffix, unit = size_suffix(size)
    close, ret = f"close{suffix}", f"ret{suffix}"
    bars = ohlcv_bars(prices, ts=ts, keys=keys, size=size, tiebreak=tiebreak, suffix=suffix)
    specs, reach = indicator_specs(close, f"high{suffix}", f"low{suffix}", ret, MA, VOL_WINDOW, LAGS, unit, on_zero=on_zero)
    ordered = with_series_columns(bars, specs + future_spec(close, horizon), keys=keys, order="ts_hour",
                                  ahead=horizon, layout=layout, **reach)
    return labelled_table(ordered, activity, keys, [name for name, _ in specs], close, size, threshold, on_zero, activity_columns, use_activity)


def labelled_table(ordered, activity, keys, indicators, close, size, threshold, on_zero, activity_columns, use_activity) -> DataFrame:
    """Bars with indicators and future close, joined to the activity and labelled, in the table's column order."""
    joined = _with_activity(ordered, activity, keys, activity_columns, use_activity, size)
    labelled = finish_labels(joined, close, threshold, on_zero)
    head = [*keys, "ts_hour", *(f"{c}{size_suffix(size)[0]}" for c in BAR_NAMES), *indicators]
    right = [c for c in labelled.columns if c not in head and c not in LABEL_COLUMNS]
    return labelled.select(*head, *right, *LABEL_COLUMNS)


def _with_activity(bars, activity, keys, columns, enabled, size) -> DataFrame:
    """Join hourly activity on the hour in which a bar begins; hourly and longer bars on their own start."""
    if activity is None or not enabled or interval_seconds(size) >= 3600:
        return join_activity(bars, activity, keys=keys, columns=columns, enabled=enabled)
    ntz = isinstance(bars.schema["ts_hour"].dataType, TimestampNTZType)
    timed = bars.withColumn(_HOUR, bucket_floor("ts_hour", "1 hour", ntz=ntz))
    hourly = activity.withColumnRenamed("ts_hour", _HOUR)
    return join_activity(timed, hourly, on=_HOUR, keys=keys, columns=columns).drop(_HOUR)
