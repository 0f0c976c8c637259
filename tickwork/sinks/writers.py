"""Table sinks (K1-K4)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

log = logging.getLogger(__name__)

STATS_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("block_count", T.LongType()),
        T.StructField("tx_count_hour", T.LongType()),
        T.StructField("total_value_hour", T.DoubleType()),
    ]
)
# Fixed value: field order of the metrics record.
METRICS_COLUMNS = ("auc_roc", "accuracy", "n_train", "n_test")


def write_parquet(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                  sort_by: Sequence[str] = ()) -> None:
    """Write ``df`` (optionally projected, and range-sorted for ordered output) as Parquet, overwriting."""
    out = df.select(*columns) if columns else df
    if sort_by:
        # Distributed range sort, for small aggregated tables (hours, days): its sampling pass
        # re-runs only the stage after the aggregate's shuffle, never the raw scan.
        out = out.sort(*sort_by)
    out.write.mode("overwrite").parquet(path)


def write_hourly_stats(stats: DataFrame, path: str) -> None:
    """K1 + O2: hourly block statistics in fixed column order, sorted by time.

    The column order and types are fixed by an explicit schema, so an empty
    input still writes a readable table with the four columns.
    """
    typed = stats.select(*[stats[f.name].cast(f.dataType).alias(f.name) for f in STATS_SCHEMA.fields])
    write_parquet(typed, path, sort_by=["timestamp"])


def write_proxy(proxy: DataFrame, path: str) -> None:
    """K2: forward-filled proxy table (``timestamp, total_value_hour, tx_count_hour, block_count``)."""
    write_parquet(proxy, path, columns=["timestamp", "total_value_hour", "tx_count_hour", "block_count"],
                  sort_by=["timestamp"])


def write_features(features: DataFrame, path: str, keys: Sequence[str] = (), ts: str = "ts_hour") -> None:
    """O1: the labelled feature table as Parquet in one order over all files: by time, then series.

    The range sort samples its input, so the table is first written as it comes and sorted from there: the window
    stages before it run once.
    """
    from tickwork.operators.series import materialize

    write_parquet(materialize(features, "features"), path, sort_by=[ts, *keys])


def write_metrics_csv(metrics: DataFrame, path: str) -> bool:
    """K3: metrics as one CSV part with a header, overwriting; an IO error is logged, not raised."""
    try:
        metrics.select(*METRICS_COLUMNS).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        return True
    except Exception as exc:  # noqa: BLE001 - the source pipeline only logs sink failures
        log.error("failed to save metrics CSV to %s: %s", path, exc)
        return False


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = "auc_roc double, accuracy double, n_train int, n_test int"
    return spark.read.option("header", True).schema(schema).csv(path)


def save_model(model: PipelineModel, path: str) -> bool:
    """K4: save the fitted pipeline, overwriting; a failure is a warning."""
    try:
        model.write().overwrite().save(path)
        return True
    except Exception as exc:  # noqa: BLE001
        log.warning("could not save model to %s: %s", path, exc)
        return False


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
