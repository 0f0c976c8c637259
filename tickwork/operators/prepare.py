"""Feature selection, null policy and the time split."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# The source pipeline's default feature lists and label column.
PRICE_FEATURES = ("ret_1h", "vol_1h", "volatility_1h", "high_low_ratio", "ma_close_3h", "ma_close_12h")
ACTIVITY_FEATURES = ("tx_count_hour",)
LABEL = "label_up"


def select_features(
    columns: Sequence[str],
    price_features: Sequence[str] = PRICE_FEATURES,
    activity_features: Sequence[str] = ACTIVITY_FEATURES,
    use_activity: bool = True,
) -> list[str]:
    """P13 + P14: requested features that exist, in request order; absent ones are logged and ignored."""
    wanted = list(price_features) + (list(activity_features) if use_activity else [])
    present = [c for c in wanted if c in columns]
    missing = [c for c in wanted if c not in columns]
    if missing:
        log.warning("features missing from the data and ignored: %s", missing)
    return present


def apply_null_policy(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    zero_fill: Sequence[str] = ACTIVITY_FEATURES,
) -> DataFrame:
    """P15 + P16: NULL/NaN in ``zero_fill`` features -> 0.0, then drop rows with a NULL/NaN feature or label."""
    fill = {c: 0.0 for c in zero_fill if c in features}
    out = df.fillna(fill) if fill else df
    return out.dropna(subset=[*features, label])


def time_split(
    df: DataFrame, train_end: str, test_start: str, ts: str = "ts_hour"
) -> tuple[DataFrame, DataFrame]:
    """Train ``ts <= train_end``, test ``ts >= test_start``.

    Date strings compare as midnight: with ``train_end='2021-12-31'`` the hours
    01:00-23:00 of that day fall in neither set (kept from the source pipeline).
    """
    return df.filter(F.col(ts) <= F.lit(train_end)), df.filter(F.col(ts) >= F.lit(test_start))


def split_counts(df: DataFrame, train_end: str, test_start: str, ts: str = "ts_hour") -> DataFrame:
    """A4: sizes of both sets and of the gap between them, in one job over the data."""
    t = F.col(ts)
    is_train = t <= F.lit(train_end)
    is_test = t >= F.lit(test_start)
    return df.agg(
        F.count_if(is_train).alias("n_train"),
        F.count_if(is_test).alias("n_test"),
        F.count_if(~is_train & ~is_test).alias("n_gap"),
    )
