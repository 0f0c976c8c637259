"""C2 + C3: train and evaluate a classifier on the labelled table; the end-to-end run."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork.operators.prepare import (
    ACTIVITY_FEATURES,
    LABEL,
    PRICE_FEATURES,
    apply_null_policy,
    select_features,
    time_split,
)
from tickwork.operators.series import Layout
from tickwork.plans.evaluate import accuracy, auc_roc, metrics_frame
from tickwork.plans.features import build_features
from tickwork.plans.model import classifier_pipeline

log = logging.getLogger(__name__)


@dataclass
class RunParams:
    """Parameters of one end-to-end run (the source pipeline's configuration, as values)."""

    train_end: str
    test_start: str
    model_type: str = "random_forest"
    model_params: Mapping[str, Any] = field(default_factory=dict)
    price_features: Sequence[str] = PRICE_FEATURES
    activity_features: Sequence[str] = ACTIVITY_FEATURES
    use_activity: bool = True
    label: str = LABEL
    horizon: int = 1
    threshold: float = 0.001
    keys: Sequence[str] = ()
    size: str = "1 hour"
    tiebreak: Sequence[str] = ()
    on_zero: str = "error"
    layout: Layout | None = None


def _features_of(columns: Sequence[str], params: RunParams) -> tuple[list[str], Sequence[str]]:
    """Features that exist, and those whose NULLs become zero."""
    features = select_features(columns, params.price_features, params.activity_features, params.use_activity)
    return features, params.activity_features if params.use_activity else ()


def _fit_and_score(
    train: DataFrame, test: DataFrame, features: Sequence[str], params: RunParams
) -> tuple[DataFrame, PipelineModel]:
    """Fit on prepared rows, score the others once, and take the metrics off the cached scores."""
    model = classifier_pipeline(features, params.model_type, params.model_params, params.label).fit(train)
    scored = model.transform(test).select(params.label, "rawPrediction", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_test = scored.count()
        auc, acc = auc_roc(scored, params.label), accuracy(scored, params.label)
    finally:
        scored.unpersist()
    n_train = train.count()
    log.info("metrics: auc=%s acc=%s n_train=%s n_test=%s", auc, acc, n_train, n_test)
    return metrics_frame(train.sparkSession, auc, acc, n_train, n_test), model


def train_and_evaluate(
    train: DataFrame, test: DataFrame, params: RunParams
) -> tuple[DataFrame, PipelineModel]:
    """Null policy, fit on train, score test, metrics record (and the fitted model).

    The training rows are persisted after the null policy: the fit passes over
    them many times (tree levels, iterations). The test rows are read once.
    """
    features, zero = _features_of(train.columns, params)
    tr = apply_null_policy(train, features, params.label, zero).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_and_score(tr, apply_null_policy(test, features, params.label, zero), features, params)
    finally:
        tr.unpersist()


def run(
    spark: SparkSession, prices: DataFrame, activity: DataFrame | None, params: RunParams
) -> tuple[DataFrame, PipelineModel]:
    """Prices (+ activity) -> labelled features -> null policy -> time split -> train and evaluate.

    The prepared rows are cached once, with the columns that training needs; both sets are filters of them.
    """
    # Only the activity features are needed for training: project the right side before the join.
    wanted = list(params.activity_features) if params.use_activity and activity is not None else None
    if wanted is not None:
        wanted = [c for c in wanted if c in activity.columns]
    labelled = build_features(prices, activity, keys=params.keys, size=params.size, tiebreak=params.tiebreak,
                              horizon=params.horizon, threshold=params.threshold, use_activity=params.use_activity,
                              activity_columns=wanted, on_zero=params.on_zero, layout=params.layout)
    features, zero = _features_of(labelled.columns, params)
    prepared = apply_null_policy(labelled, features, params.label, zero).select("ts_hour", *features, params.label)
    prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = time_split(prepared, params.train_end, params.test_start)
        return _fit_and_score(train, test, features, params)
    finally:
        prepared.unpersist()


def class_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of the positive class -- the majority-class baseline next to an accuracy."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_share"))


# ---------------------------------------------------------------- configuration-driven run (C3 as `main`)
def params_from_config(cfg: Mapping[str, Any], **own: Any) -> RunParams:
    """RunParams from a configuration mapping with the source pipeline's keys (already parsed).

    ``own`` sets what that pipeline has no key for: ``keys``, ``size``, ``tiebreak``, ``on_zero``, ``layout``.
    """
    feats, model, train = cfg.get("features", {}), cfg.get("model", {}), cfg.get("train", {})
    return RunParams(
        train_end=train["train_end_date"],
        test_start=train["test_start_date"],
        model_type=model.get("type", "random_forest"),
        model_params=dict(model.get("params", {}) or {}),
        price_features=tuple(feats.get("price_features", PRICE_FEATURES)),
        activity_features=tuple(feats.get("blockchain_features", ACTIVITY_FEATURES)),
        use_activity=bool(feats.get("use_blockchain", False)),
        label=cfg.get("label_col", LABEL),
        horizon=int(cfg.get("etl", {}).get("label_horizon_hours", 1)),
        **own,
    )


# Where the source pipeline writes without an ``output`` section.
DEFAULT_METRICS_CSV, DEFAULT_MODELS_DIR = "output/metrics.csv", "output/models"


def sources_from_config(spark: SparkSession, cfg: Mapping[str, Any]) -> tuple[DataFrame, DataFrame | None]:
    """Candle CSV (column names, date bounds) and the optional activity Parquet named by ``data.*``."""
    from tickwork.sources import load_activity, load_candles_csv
    from tickwork.sources.candles import DEFAULT_COLUMNS, DEFAULT_TS_COLUMN

    data = cfg["data"]
    # config keys price_open_col ... price_volume_col name the source columns of open ... volume
    names = {data.get(f"price_{dst}_col", src): dst for src, dst in DEFAULT_COLUMNS.items()}
    prices = load_candles_csv(spark, data["price_path"], ts_col=data.get("price_timestamp_col", DEFAULT_TS_COLUMN),
                              columns=names, start=data.get("start_date"), end=data.get("end_date"))
    return prices, load_activity(spark, data.get("blockchain_path"))


def run_config(spark: SparkSession, cfg: Mapping[str, Any], **own: Any) -> tuple[DataFrame, PipelineModel]:
    """The source pipeline's end-to-end run from its configuration mapping, sinks included.

    Metrics go to ``output.metrics_csv``, the model under ``output.models_dir``, by default to the source pipeline's
    places. Both sinks are tried; if one fails, the run raises after the other.
    """
    from tickwork.sinks import save_model, write_metrics_csv

    params = params_from_config(cfg, **own)
    prices, activity = sources_from_config(spark, cfg)
    metrics, model = run(spark, prices, activity, params)
    out = cfg.get("output", {}) or {}
    metrics_path = out.get("metrics_csv", DEFAULT_METRICS_CSV)
    model_path = f"{out.get('models_dir', DEFAULT_MODELS_DIR).rstrip('/')}/{params.model_type}_pipeline"
    failed = [path for path, done in ((metrics_path, write_metrics_csv(metrics, metrics_path)),
                                      (model_path, save_model(model, model_path))) if not done]
    if failed:
        raise RuntimeError(f"the run succeeded, but could not write {' and '.join(failed)} (see the log)")
    return metrics, model
