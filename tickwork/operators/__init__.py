"""DataFrame operators: bars, series windows, indicators, labels, joins, resampling, preparation."""

from tickwork.operators.bars import hourly_bars, ohlcv_bars
from tickwork.operators.barstate import append_state, bar_state, bars_from_state, compact, merge_states, read_state
from tickwork.operators.blockstats import hourly_block_stats, total_blocks
from tickwork.operators.enrich import join_activity
from tickwork.operators.indicators import (
    add_indicators,
    high_low_ratio,
    lagged_returns,
    log_returns,
    moving_averages,
    rolling_volatility,
)
from tickwork.operators.labels import add_labels
from tickwork.operators.longframes import long_frames
from tickwork.operators.prepare import apply_null_policy, select_features, split_counts, time_split
from tickwork.operators.resample import daily_to_hourly_proxy, latest_rows, resample_ffill
from tickwork.operators.running import auc_by_ranks, file_positions, with_positions, with_running_totals
from tickwork.operators.series import (
    DEFAULT_LAYOUT,
    PARTITIONED,
    Layout,
    layout_for_bar_size,
    with_series_columns,
)

__all__ = [
    "DEFAULT_LAYOUT",
    "PARTITIONED",
    "Layout",
    "add_indicators",
    "add_labels",
    "append_state",
    "apply_null_policy",
    "auc_by_ranks",
    "bar_state",
    "bars_from_state",
    "compact",
    "daily_to_hourly_proxy",
    "file_positions",
    "high_low_ratio",
    "hourly_bars",
    "hourly_block_stats",
    "join_activity",
    "latest_rows",
    "layout_for_bar_size",
    "lagged_returns",
    "log_returns",
    "long_frames",
    "merge_states",
    "moving_averages",
    "ohlcv_bars",
    "read_state",
    "resample_ffill",
    "rolling_volatility",
    "select_features",
    "split_counts",
    "time_split",
    "total_blocks",
    "with_positions",
    "with_running_totals",
    "with_series_columns",
]
