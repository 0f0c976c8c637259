"""Evaluation and the metrics record."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("auc_roc", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("n_train", T.IntegerType()),
        T.StructField("n_test", T.IntegerType()),
    ]
)


def auc_roc(preds: DataFrame, label: str = "label_up", raw: str = "rawPrediction", num_bins: int = 0) -> float:
    """M8: area under ROC. ``num_bins=0`` gives the exact value (the evaluator's default 1000 bins approximates)."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC",
                                       numBins=num_bins)
    return float(ev.evaluate(preds.withColumn(label, F.col(label).cast("double"))))


def accuracy(preds: DataFrame, label: str = "label_up", prediction: str = "prediction") -> float:
    """M9: share of rows whose prediction equals the label."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")
    return float(ev.evaluate(preds.withColumn(label, F.col(label).cast("double"))))


def metrics_frame(spark: SparkSession, auc: float, acc: float, n_train: int, n_test: int) -> DataFrame:
    """The one-row metrics record ``auc_roc, accuracy, n_train, n_test``."""
    return spark.createDataFrame([(float(auc), float(acc), int(n_train), int(n_test))], METRICS_SCHEMA)
