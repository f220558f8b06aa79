"""Popularity-tier classifier on MLlib: pipelines, training, batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import lookup
from trackmart.operators import forest
from trackmart.operators.features import FEATURE_SQL, GENRE_CODE_SQL, score_defaults

# Forest settings of the two published models.
FULL_FOREST = {
    "numTrees": 300,
    "maxDepth": 15,
    "minInstancesPerNode": 3,
    "featureSubsetStrategy": "sqrt",
    "impurity": "gini",
    "subsamplingRate": 0.8,
    "seed": 42,
}
COMPACT_FOREST = {"numTrees": 20, "maxDepth": 15, "seed": 42}

FULL_FEATURES = [*S.BASE_FEATURES, *S.ENGINEERED_FEATURES, "genre_idx"]
COMPACT_FEATURES = [*S.BASE_FEATURES, "genre_idx"]


def genre_indexer() -> StringIndexer:
    """Genre groups by falling frequency, then name; unseen ones get an extra index."""
    return StringIndexer(inputCol="genre_group", outputCol="genre_idx", handleInvalid="keep")


def label_indexer() -> StringIndexer:
    return StringIndexer(inputCol="popularity_tier", outputCol="label", handleInvalid="error")


def feature_assembler(inputs: list[str], output: str) -> VectorAssembler:
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep")


def standard_scaler() -> StandardScaler:
    return StandardScaler(
        inputCol="features_raw", outputCol="features", withMean=True, withStd=True
    )


def _derive(columns: dict[str, str]) -> SQLTransformer:
    """Derived columns as a stage, so fitting and scoring cannot drift apart."""
    extra = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {extra} FROM __THIS__")


def scaling_stages() -> list:
    """Engineered features, genre index, assembly and standardisation."""
    return [
        _derive(FEATURE_SQL),
        genre_indexer(),
        feature_assembler(FULL_FEATURES, "features_raw"),
        standard_scaler(),
    ]


def compact_stages() -> list:
    """Fixed genre codes and unscaled inputs."""
    return [_derive({"genre_idx": GENRE_CODE_SQL}), feature_assembler(COMPACT_FEATURES, "features")]


def _pipeline(stages: list, settings: dict) -> Pipeline:
    trees = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="class_weight", **settings
    )
    return Pipeline(stages=[label_indexer(), *stages, trees])


def full_pipeline(**overrides) -> Pipeline:
    """The 20-feature model; keyword arguments override forest settings."""
    return _pipeline(scaling_stages(), {**FULL_FOREST, **overrides})


def compact_pipeline(**overrides) -> Pipeline:
    """The 12-feature model; keyword arguments override forest settings."""
    return _pipeline(compact_stages(), {**COMPACT_FOREST, **overrides})


def tier_labels(model: PipelineModel) -> list[str]:
    """Tier names in the order of the model's class indices, as fitted."""
    return list(model.stages[0].labels)


def score_tracks(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Score a table of requests: tier, confidence %, message, per-tier % struct.

    Missing inputs take their defaults; all columns of the request are kept but
    a tier it may bring along. Without one the label stage does nothing.
    """
    labels = tier_labels(model)
    inputs = requests.drop("popularity_tier")
    raw = forest.model_scores(model, score_defaults(inputs))
    shares = vector_to_array("probability")
    index = F.col("prediction").cast("int")

    def percent(share: Column) -> Column:
        return F.round(F.coalesce(share, F.lit(0.0)) * 100, 1)

    by_tier = F.struct(
        *[
            (percent(shares[labels.index(t)]) if t in labels else F.lit(0.0)).alias(t)
            for t in S.TIERS
        ]
    )
    tier = F.coalesce(F.get(F.array(*map(F.lit, labels)), index), F.lit(S.TIER_FALLBACK))
    scored = raw.select(
        *inputs.columns,
        tier.alias("popularity_tier"),
        percent(F.get(shares, index)).alias("confidence"),
        by_tier.alias("probabilities"),
    )
    return scored.withColumn("message", lookup(S.TIER_MESSAGES, F.col("popularity_tier"), ""))
