"""Model quality figures, all derived from one count of (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart.functions import round_exact


def confusion_matrix(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    counted = predictions.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(label, prediction)


def confusion_dense(
    predictions: DataFrame,
    classes: Sequence,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """One row per actual class, one column per predicted class, absent cells 0."""
    return (
        predictions.groupBy(label)
        .pivot(prediction, list(classes))
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .orderBy(label)
    )


def metrics_from_confusion(
    confusion: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Weighted F1, accuracy, weighted precision and recall, to four decimals.

    The windows run over confusion cells, at most (classes squared) rows. A class
    that is never predicted has precision 0.
    """
    cell = F.col("row_count")
    sized = confusion.select(
        (F.col(label) == F.col(prediction)).alias("hit"),
        cell,
        F.sum(cell).over(Window.partitionBy(label)).alias("actual"),
        F.sum(cell).over(Window.partitionBy(prediction)).alias("predicted"),
        F.sum(cell).over(Window.partitionBy()).alias("total"),
    )

    def weighted(score: Column) -> Column:
        hits = F.sum(F.when(F.col("hit"), F.col("actual") / F.col("total") * score))
        return round_exact(F.coalesce(hits, F.lit(0.0)), 4)

    recall = cell / F.col("actual")
    return sized.agg(
        weighted(2 * cell / (F.col("actual") + F.col("predicted"))).alias("f1"),
        weighted(recall).alias("accuracy"),
        weighted(cell / F.col("predicted")).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def classification_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return metrics_from_confusion(
        confusion_matrix(predictions, label, prediction), label, prediction
    )


def feature_names(model: PipelineModel) -> list[str]:
    """Input columns of the assembled vector, in slot order."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Features by importance, most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, round(float(w), 6)) for name, w in zip(feature_names(model), weights)]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


_REPORT = """
    generated_at timestamp, model string, label string, features array<string>,
    num_trees int, max_depth int, subsampling_rate double,
    class_weights map<string, double>, train_rows bigint, test_rows bigint,
    metrics struct<f1: double, accuracy: double, weighted_precision: double, weighted_recall: double>,
    confusion_matrix array<struct<actual: int, predicted: int, count: bigint>>,
    feature_importance array<struct<feature: string, importance: double>>,
    model_path string
"""


def model_report(
    model: PipelineModel,
    predictions: DataFrame,
    weights: DataFrame,
    train_rows: int,
    generated_at: datetime,
    model_path: str | None = None,
) -> DataFrame:
    """One nested row describing a trained model and its test results.

    The predictions are read once, for the confusion counts; everything else is
    derived from those few rows.
    """
    spark = predictions.sparkSession
    cells = confusion_matrix(predictions).collect()
    confusion = spark.createDataFrame(cells, "label double, prediction double, row_count bigint")
    metrics = metrics_from_confusion(confusion).first()
    forest = model.stages[-1]
    row = (
        generated_at,
        type(forest).__name__.removesuffix("Model").removesuffix("Classification"),
        "popularity_tier",
        feature_names(model),
        forest.getNumTrees,
        forest.getMaxDepth(),
        forest.getSubsamplingRate(),
        {r["popularity_tier"]: r["class_weight"] for r in weights.collect()},
        train_rows,
        sum(c["row_count"] for c in cells),
        tuple(metrics),
        [(int(c["label"]), int(c["prediction"]), c["row_count"]) for c in cells],
        [tuple(r) for r in feature_importance(model, spark).collect()],
        model_path,
    )
    return spark.createDataFrame([row], _REPORT)
