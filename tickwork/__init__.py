"""tickwork: time-series bars, indicators, labels and direction models as Spark DataFrame operators.

Typical use::

    from tickwork import build_features, run, RunParams, load_candles_csv, load_activity
"""

import sys as _sys

# Ship this package's code *by value* with every Python UDF (mapInPandas / applyInPandas):
# executors then need no installed copy of tickwork, whatever their working directory or path.
try:  # pragma: no cover - depends on the cloudpickle vendored by pyspark
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):
    pass

from tickwork.operators import (  # noqa: E402
    Layout,
    add_indicators,
    add_labels,
    daily_to_hourly_proxy,
    hourly_bars,
    hourly_block_stats,
    join_activity,
    ohlcv_bars,
    resample_ffill,
    with_series_columns,
)
from tickwork.plans import RunParams, build_features, run, train_and_evaluate  # noqa: E402
from tickwork.sources import load_activity, load_candles_csv, load_candles_parquet, read_block_files  # noqa: E402

__version__ = "0.1.0"

__all__ = [
    "Layout",
    "RunParams",
    "add_indicators",
    "add_labels",
    "build_features",
    "daily_to_hourly_proxy",
    "hourly_bars",
    "hourly_block_stats",
    "join_activity",
    "load_activity",
    "load_candles_csv",
    "load_candles_parquet",
    "ohlcv_bars",
    "read_block_files",
    "resample_ffill",
    "run",
    "train_and_evaluate",
    "with_series_columns",
]
