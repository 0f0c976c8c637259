"""Forward-return labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.functions.returns import simple_return, up_label
from tickwork.operators.series import ColumnBuilder, Layout, layout_for_bar_size, with_series_columns

# Fixed values of the source pipeline: label threshold (strict ">") and horizon.
DEFAULT_THRESHOLD = 0.001
DEFAULT_HORIZON = 1


def future_spec(close: str, horizon: int, name: str = "close_future") -> list[tuple[str, ColumnBuilder]]:
    """The close ``horizon`` rows ahead."""
    return [(name, lambda s: F.lead(close, horizon).over(s.rows))]


def finish_labels(df: DataFrame, close: str = "close_1h", threshold: float = DEFAULT_THRESHOLD,
                  on_zero: str = "error") -> DataFrame:
    """P9-P11 on a frame that already has ``close_future``: return, label, drop rows without a future."""
    return (
        df.withColumn("return_future", simple_return("close_future", close, on_zero))
        .withColumn("label_up", up_label("return_future", threshold))
        .dropna(subset=["close_future", "return_future"])
    )


def add_labels(
    df: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts_hour", close: str = "close_1h",
    horizon: int = DEFAULT_HORIZON, threshold: float = DEFAULT_THRESHOLD, on_zero: str = "error",
    size: str = "1 hour", layout: Layout | None = None,
) -> DataFrame:
    """``close_future, return_future, label_up``; the last ``horizon`` rows of each series drop out.

    With ``on_zero="null"`` a bar that closes at zero has no return and drops out too.
    """
    if horizon < 1:
        raise ValueError("horizon must be >= 1")
    out = with_series_columns(df, future_spec(close, horizon), keys=keys, order=ts, ahead=horizon,
                              layout=layout or layout_for_bar_size(size))
    return finish_labels(out, close, threshold, on_zero)
