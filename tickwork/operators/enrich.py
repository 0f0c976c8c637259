"""Left join of an hourly activity series onto price features."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def join_activity(
    features: DataFrame,
    activity: DataFrame | None,
    *,
    on: str = "ts_hour",
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    enabled: bool = True,
) -> DataFrame:
    """Left outer equi-join ``USING (keys present on both sides, on)``.

    Every feature row is kept; a right side with two rows for one hour yields
    two rows (nothing dedupes). ``activity=None`` or ``enabled=False`` returns
    ``features`` unchanged (J2). ``columns`` projects the right side before the
    join so unused activity columns are neither read nor shuffled.

    The strategy is left to Spark: an hourly activity table is bounded by the
    time span, and AQE turns the join into a broadcast when the measured size
    of the right side is under the threshold; otherwise it stays a sort-merge
    join on the hour key.
    """
    if activity is None or not enabled:
        log.info("activity join skipped (disabled or no data)")
        return features
    join_keys = [k for k in keys if k in activity.columns] + [on]
    right = activity
    if columns is not None:
        right = activity.select(*join_keys, *[c for c in columns if c not in join_keys])
    return features.join(right, on=join_keys, how="left")
