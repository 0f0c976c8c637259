"""Sinks: Parquet tables, metrics CSV, fitted models, raw block files."""

from tickwork.sinks.publish import PublishedTable
from tickwork.sinks.scratch import drop_scratch, scratch_mark, scratch_path, shared_dir
from tickwork.sinks.writers import (
    load_model,
    read_metrics_csv,
    save_model,
    write_features,
    write_hourly_stats,
    write_metrics_csv,
    write_parquet,
    write_proxy,
)

__all__ = [
    "PublishedTable",
    "drop_scratch",
    "load_model",
    "read_metrics_csv",
    "save_model",
    "scratch_mark",
    "scratch_path",
    "shared_dir",
    "write_features",
    "write_hourly_stats",
    "write_metrics_csv",
    "write_parquet",
    "write_proxy",
]
