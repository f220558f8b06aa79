"""Train, evaluate and save the popularity-tier models."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.operators import evaluation, forest, model, splits
from trackmart.operators.features import training_rows
from trackmart.session import materialize, scratch_path, staged
from trackmart.sinks.tables import announce, write_report
from trackmart.sources.snapshots import current_version, snapshot_path

FULL, COMPACT = "full", "compact"


def split_rows(tracks: DataFrame, kind: str = FULL) -> DataFrame:
    """Complete training rows with their ``split``: by hash of the key for the
    full model, by hash within each tier for the compact one."""
    rows = training_rows(tracks).select("track_id", *S.TRAINING_COLUMNS)
    return splits.hash_split(rows) if kind == FULL else splits.stratified_split(rows)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    predictions: DataFrame  # on the test rows
    train: DataFrame
    weights: DataFrame


def train_on(
    frame: DataFrame,
    kind: str,
    weigh_all: bool = False,
    max_label_rows: int | None = None,
    **settings,
) -> Trained:
    """Train on a stored split frame; fitting passes over it many times.

    Weights come from the training rows, or from all rows with ``weigh_all``. The forest is
    fitted on all training rows by fits that share its trees; only where the caller bounds them
    is it the first ``max_label_rows`` by a hash of the key. Weights, evaluation and scoring
    cover all rows either way.
    """
    train, test = (frame.filter(F.col("split") == part) for part in (splits.TRAIN, splits.TEST))
    digits = 2 if kind == FULL else None
    counted = splits.class_weights(frame if weigh_all else train, digits=digits)
    # One row per tier, held here so that each pass of the fit does not count anew.
    weights = frame.sparkSession.createDataFrame(counted.collect(), counted.schema)
    build = model.full_pipeline if kind == FULL else model.compact_pipeline
    weighted = splits.add_class_weights(train, weights)
    if max_label_rows is not None:
        weighted = splits.first_by_hash(weighted, max_label_rows)
    spark = frame.sparkSession
    path, parts = scratch_path(spark, "forest-parts"), spark.sparkContext.defaultParallelism
    with staged(spread(weighted), "fitting-rows") as rows:
        fitted = forest.fit_in_parts(build(**settings), rows, path, parts)
    return Trained(fitted, forest.model_scores(fitted, test), train, weights)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over as many tasks as there are cores, dealt and ordered by key, so that a fit
    uses them all and draws the same bags at every run."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks, "track_id").sortWithinPartitions("track_id")


def train_model(tracks: DataFrame, kind: str = FULL, **settings) -> Trained:
    """:func:`train_on` for tracks that are not split yet. The split stays in scratch, as the
    result reads it."""
    frame = materialize(split_rows(tracks, kind), f"training-{kind}")
    return train_on(frame, kind, **settings)


@dataclass(frozen=True)
class Signature:
    """What a stored model takes and gives: checked before anything is scored with it."""

    kind: str
    inputs: list[str]
    features: list[str]
    labels: list[str]
    settings: dict[str, float]


class ModelMismatch(ValueError):
    """A stored model is not what its signature, or the caller, says."""


def signature(fitted: PipelineModel, kind: str) -> Signature:
    trees = fitted.stages[-1]
    return Signature(
        kind,
        [*S.BASE_FEATURES, "genre_group"],
        evaluation.feature_names(fitted),
        model.tier_labels(fitted),
        {"num_trees": trees.getNumTrees, "max_depth": trees.getMaxDepth(), "classes": trees.numClasses},
    )


def save_model(
    spark: SparkSession, fitted: PipelineModel, root: str, kind: str, version: str, now: datetime
) -> str:
    """Write a model and its signature as a new snapshot, then make it the current one.

    Snapshots are immutable: a scorer that has resolved the current one keeps reading it
    while the next is written. A version is written once.
    """
    path = snapshot_path(root, version)
    fitted.save(f"{path}/model")  # fails if the version is there
    row = spark.createDataFrame([(json.dumps(asdict(signature(fitted, kind))),)], "value string")
    row.coalesce(1).write.text(f"{path}/signature")
    announce(spark, root, version, now)
    return path


def train_and_save(
    tracks: DataFrame, path: str, now: datetime, kind: str = FULL, version: str | None = None, **settings
) -> DataFrame:
    """Train, save model and report under ``path``, and return the report row.

    The model becomes a snapshot named ``version``, by default after the time.
    """
    spark = tracks.sparkSession
    version = version or now.strftime("%Y%m%dT%H%M%S%f")
    with staged(split_rows(tracks, kind), f"training-{kind}") as frame:
        result = train_on(frame, kind, **settings)
        saved = save_model(spark, result.model, path, kind, version, now)
        report = evaluation.model_report(
            result.model,
            result.predictions,
            result.weights,
            result.train.count(),
            now,
            f"{saved}/model",
        )
    write_report(report, f"{path}/report")
    return report


def load_model(path: str, kind: str | None = None, version: str | None = None) -> PipelineModel:
    """The current model under ``path``, or that of a version, once its signature is checked.

    The signature must be that of the model beside it, and the model must be of ``kind``,
    take the library's inputs and name only its tiers.
    """
    spark = SparkSession.active()
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no model under {path}")
    folder = snapshot_path(path, version)
    stored = Signature(**json.loads(spark.read.text(f"{folder}/signature").first()[0]))
    if kind not in (None, stored.kind):
        raise ModelMismatch(f"{folder} holds a {stored.kind} model, not a {kind} one")
    fitted = PipelineModel.load(f"{folder}/model")
    found = signature(fitted, stored.kind)
    if found != stored:
        wrong = [name for name, value in asdict(found).items() if value != getattr(stored, name)]
        raise ModelMismatch(f"{folder}: {', '.join(wrong)} differ from the signature")
    if stored.features != (model.FULL_FEATURES if stored.kind == FULL else model.COMPACT_FEATURES):
        raise ModelMismatch(f"{folder}: the model's features are not the library's")
    if not set(stored.labels) <= set(S.TIERS):
        raise ModelMismatch(f"{folder}: labels {stored.labels} are not all tiers")
    return fitted
