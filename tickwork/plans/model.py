"""Classifier pipelines (M1-M7): assemble -> standardise -> classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler

# Default hyper-parameters per model type of the source pipeline.
MODEL_DEFAULTS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"maxIter": 50, "regParam": 0.0, "elasticNetParam": 0.0},
    "gbt": {"maxDepth": 5, "maxIter": 50, "stepSize": 0.1, "seed": 42},
    "random_forest": {"numTrees": 100, "maxDepth": 10, "seed": 42},
}
_FACTORIES = {
    "logistic_regression": LogisticRegression,
    "gbt": GBTClassifier,
    "random_forest": RandomForestClassifier,
}


def make_classifier(model_type: str, params: Mapping[str, Any] | None = None, *, label: str = "label_up",
                    features: str = "features"):
    """M3-M6: estimator by name with defaults overridden by ``params``; unknown name -> ``ValueError``."""
    if model_type not in _FACTORIES:
        raise ValueError(f"{model_type!r} is none of the models {', '.join(_FACTORIES)}")
    merged = {**MODEL_DEFAULTS[model_type], **{k: v for k, v in (params or {}).items()
                                               if k in MODEL_DEFAULTS[model_type]}}
    return _FACTORIES[model_type](labelCol=label, featuresCol=features, **merged)


def assembler(features: Sequence[str], out: str = "features_raw") -> VectorAssembler:
    """M1: feature vector; rows with an invalid value are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip")


def scaler(inp: str = "features_raw", out: str = "features") -> StandardScaler:
    """M2: mean 0, sample deviation 1; a zero-variance feature becomes 0.0."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def classifier_pipeline(features: Sequence[str], model_type: str = "random_forest",
                        params: Mapping[str, Any] | None = None, label: str = "label_up") -> Pipeline:
    """M7: the three-stage pipeline."""
    return Pipeline(stages=[assembler(features), scaler(), make_classifier(model_type, params, label=label)])
