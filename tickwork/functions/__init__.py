"""Column-level helpers (pure ``pyspark.sql.functions`` expressions)."""

from tickwork.functions.time import (
    bucket_start,
    epoch_seconds_ntz,
    epoch_to_utc_ntz,
    hour_text,
    parse_timestamp,
    truncate_hour,
)
from tickwork.functions.returns import log_return, ratio, simple_return, up_label

__all__ = [
    "bucket_start",
    "epoch_seconds_ntz",
    "epoch_to_utc_ntz",
    "hour_text",
    "log_return",
    "parse_timestamp",
    "ratio",
    "simple_return",
    "truncate_hour",
    "up_label",
]
