"""The feature table in steps: each run reads new ticks only.

Indicators look back over some bars, and the labels of a series' last bars are
open until later bars come. A run therefore leaves a carry table behind: the last
bars of each series, as many as the indicators of its open bars look back over,
and for each whether its label is out. The next run puts new bars behind them,
gives out the rows whose label is known now, and leaves the next carry. Rows come
out once each, and all runs together give the rows of one run over everything.

The carry holds a fixed number of bars a series, whatever the history's length.
A run must get the ticks of whole bars: bars from ``until`` on are left for the
next run, which has to read their ticks again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.operators.bars import ohlcv_bars
from tickwork.operators.indicators import indicator_specs
from tickwork.operators.labels import DEFAULT_HORIZON, DEFAULT_THRESHOLD, future_spec
from tickwork.operators.series import Layout, layout_for_bar_size, materialize, with_series_columns
from tickwork.plans.features import LAGS, MA, VOL_WINDOW, labelled_table, size_suffix

DONE = "label_out"
_KNOWN, _LATER = "_tw_known", "_tw_later"


def features_step(
    prices: DataFrame,
    carry: DataFrame | None = None,
    activity: DataFrame | None = None,
    *,
    until: str | None = None,
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
) -> tuple[DataFrame, DataFrame]:
    """Rows of :func:`tickwork.plans.features.build_features` that the new ``prices`` complete, and the next carry.

    ``carry`` is what the run before left, None in the first run. ``activity`` must hold the hours of the rows that come
    out: those of the new bars and of the ``horizon`` bars before. Both results read written tables, not ``prices``.
    """
    keys = list(keys)
    layout = layout or layout_for_bar_size(size)
    suffix, unit = size_suffix(size)
    close = f"close{suffix}"
    bars = ohlcv_bars(prices, ts=ts, keys=keys, size=size, tiebreak=tiebreak, suffix=suffix)
    if until is not None:
        bars = bars.where(F.col("ts_hour") < F.lit(until).cast(bars.schema["ts_hour"].dataType))
    fresh = bars.withColumn(DONE, F.lit(False))
    known = materialize(fresh if carry is None else carry.unionByName(fresh), "carried_bars")

    specs, reach = indicator_specs(close, f"high{suffix}", f"low{suffix}", f"ret{suffix}", MA, VOL_WINDOW, LAGS, unit, on_zero=on_zero)
    needed = reach["back"] + horizon  # what the open bars and the next ones look back over
    marks = [(_KNOWN, lambda s: F.lead(F.lit(True), horizon).over(s.rows)), (_LATER, lambda s: F.lead(F.lit(True), needed).over(s.rows))]
    ordered = materialize(with_series_columns(known, specs + future_spec(close, horizon) + marks, keys=keys, order="ts_hour", ahead=needed,
                                              layout=Layout(layout.blocked, layout.block_rows, layout.chunk, materialize=False), **reach), "ordered_bars")
    out = ordered.where(~F.col(DONE) & F.col(_KNOWN).isNotNull()).drop(DONE, _KNOWN, _LATER)
    features = labelled_table(out, activity, keys, [name for name, _ in specs], close, size, threshold, on_zero, activity_columns, use_activity)
    left = ordered.where(F.col(_LATER).isNull()).withColumn(DONE, F.col(_KNOWN).isNotNull())
    return features, materialize(left.select(*known.columns), "carry")
