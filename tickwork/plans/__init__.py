"""Composite plans: feature table, ML pipeline, evaluation, end-to-end run."""

from tickwork.plans.evaluate import accuracy, auc_roc, metrics_frame
from tickwork.plans.explain import plan_text, single_partition_exchanges
from tickwork.plans.features import build_features
from tickwork.plans.incremental import features_step
from tickwork.plans.model import MODEL_DEFAULTS, classifier_pipeline, make_classifier
from tickwork.plans.run import (
    RunParams,
    class_share,
    params_from_config,
    run,
    run_config,
    sources_from_config,
    train_and_evaluate,
)

__all__ = [
    "MODEL_DEFAULTS",
    "RunParams",
    "accuracy",
    "auc_roc",
    "build_features",
    "class_share",
    "classifier_pipeline",
    "make_classifier",
    "features_step",
    "metrics_frame",
    "params_from_config",
    "plan_text",
    "run",
    "run_config",
    "sources_from_config",
    "single_partition_exchanges",
    "train_and_evaluate",
]
