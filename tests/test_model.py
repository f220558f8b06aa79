from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tests.frames import raw, varied
from trackmart import schemas as S
from trackmart.operators import cleaning, evaluation, features, model, splits
from trackmart.plans import training

SMALL = {"numTrees": 5, "maxDepth": 4}


@pytest.fixture(scope="module")
def catalogue(spark):
    return cleaning.clean(varied(spark)).persist()


@pytest.fixture(scope="module")
def trained(catalogue):
    return training.train_model(catalogue, training.FULL, **SMALL)


def test_engineered_features(spark):
    df = features.engineered_features(raw(spark, {"year": 2019, "energy": 0.4, "valence": 0.2}))
    row = df.first()
    assert row["decade"] == 2010.0 and row["tempo_energy"] == 48.0
    assert row["dance_valence"] == pytest.approx(0.1)
    assert row["acoustic_energy"] == pytest.approx(0.18)
    assert row["loudness_energy"] == pytest.approx(20.8)
    assert row["speech_instrument"] == pytest.approx(0.05)
    assert row["duration_min"] == pytest.approx(10 / 3)
    assert row["log_duration"] == pytest.approx(12.206077645517674)


def test_genre_codes(spark):
    rows = [(g,) for g in [*S.GENRE_CODES, "Nope", None]]
    df = features.add_genre_code(spark.createDataFrame(rows, "genre_group string"))
    got = [r["genre_idx"] for r in df.collect()]
    assert got == [*S.GENRE_CODES.values(), 7, 7]


def test_score_defaults(spark):
    empty = raw(spark, {c: None for c in S.SCORE_DEFAULTS if c != "genre_group"})
    filled = features.score_defaults(empty.withColumn("genre_group", F.lit(None).cast("string")))
    row = filled.first()
    assert {c: row[c] for c in S.SCORE_DEFAULTS} == S.SCORE_DEFAULTS


def test_input_domain(spark):
    df = raw(spark, {}, {"tempo": 39.0, "year": 2024}, {"energy": None})
    rows = features.input_domain_check(df).orderBy("track_id").collect()
    assert [r["violations"] for r in rows] == [[], ["tempo", "year"], ["energy"]]


def test_hash_split_does_not_depend_on_layout(catalogue):
    once = sorted(splits.hash_split(catalogue).select("track_id", "split").collect())
    other = sorted(splits.hash_split(catalogue.repartition(13)).select("track_id", "split").collect())
    assert once == other
    share = sum(r["split"] == "train" for r in once) / len(once)
    assert 0.7 < share < 0.9


@pytest.mark.parametrize("fraction", [0.5, 0.8])
@pytest.mark.parametrize("prefix", [1, 4])
def test_stratified_split_equals_percent_rank(spark, fraction, prefix):
    """Also with repeated keys, one of which makes up a third of the rows."""
    rows = [(f"k{i % 900}", S.TIERS[0 if i % 7 else 1 + i % 2]) for i in range(1400)]
    rows += [("hot", "Low")] * 600 + [("only", "High")] * 3
    df = spark.createDataFrame(rows, "track_id string, popularity_tier string")
    split = splits.stratified_split(df, fraction=fraction, prefix=prefix)
    ours = split.groupBy("track_id", "popularity_tier", "split").count().collect()
    theirs = df.selectExpr(
        "track_id",
        "popularity_tier",
        f"""CASE WHEN percent_rank() OVER (PARTITION BY popularity_tier ORDER BY md5(track_id))
            < {fraction} THEN 'train' ELSE 'test' END AS split""",
    )
    assert sorted(ours) == sorted(
        theirs.groupBy("track_id", "popularity_tier", "split").count().collect()
    )


def test_stratified_split_of_a_single_row_class(spark):
    df = spark.createDataFrame([("a", "Low"), ("b", "None")], "track_id string, popularity_tier string")
    got = {r["track_id"]: r["split"] for r in splits.stratified_split(df).collect()}
    assert got == {"a": "train", "b": None}


def weights_of(spark, digits=2, **counts):
    rows = [(t,) for t, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "popularity_tier string")
    return {r["popularity_tier"]: r["class_weight"] for r in splits.class_weights(df, digits=digits).collect()}


def test_class_weights(spark):
    assert weights_of(spark, Low=70, Mid=21, High=9) == {"Low": 1.0, "Mid": 3.33, "High": 7.78}
    assert weights_of(spark, Low=10, Mid=5) == {"Low": 1.0, "Mid": 2.0, "High": 60.0}
    # Low stays 1 even when it is not the largest class.
    assert weights_of(spark, Low=10, Mid=20, High=5) == {"Low": 1.0, "Mid": 1.0, "High": 4.0}
    assert weights_of(spark, digits=None, Low=10, Mid=20) == {"Low": 2.0, "Mid": 1.0}


def test_add_class_weights_defaults_to_one(spark):
    df = spark.createDataFrame([("Mid",), ("Strange",)], "popularity_tier string")
    weights = splits.class_weights(df.filter("popularity_tier = 'Mid'"), digits=None)
    rows = splits.add_class_weights(df, weights).collect()
    assert {r["popularity_tier"]: r["class_weight"] for r in rows} == {"Mid": 1.0, "Strange": 1.0}


# Cells of a published confusion matrix, High never being predicted.
PUBLISHED = [
    (0.0, 0.0, 174_814),
    (0.0, 1.0, 4_040),
    (1.0, 0.0, 39_349),
    (1.0, 1.0, 9_864),
    (2.0, 0.0, 1_601),
    (2.0, 1.0, 1_237),
]


def test_metrics_of_the_published_matrix(spark):
    cells = spark.createDataFrame(PUBLISHED, "label double, prediction double, row_count bigint")
    row = evaluation.metrics_from_confusion(cells).first()
    assert tuple(row) == (0.7516, 0.7998, 0.7664, 0.7998)


def test_metrics_without_a_single_hit(spark):
    cells = spark.createDataFrame([(0.0, 1.0, 5)], "label double, prediction double, row_count bigint")
    assert tuple(evaluation.metrics_from_confusion(cells).first()) == (0.0, 0.0, 0.0, 0.0)


def test_confusion_dense_fills_absent_cells(spark):
    df = spark.createDataFrame([("Low", "Low"), ("High", "Low")], "label string, prediction string")
    rows = [tuple(r) for r in evaluation.confusion_dense(df, S.TIERS).collect()]
    assert rows == [("High", 1, 0, 0), ("Low", 1, 0, 0)]


def test_metrics_equal_the_library_evaluator(trained):
    predictions = trained.predictions
    row = evaluation.classification_metrics(predictions).first()
    names = {"f1": "f1", "accuracy": "accuracy", "weighted_precision": "weightedPrecision",
             "weighted_recall": "weightedRecall"}
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(metricName=theirs)
        assert row[ours] == pytest.approx(evaluator.evaluate(predictions), abs=6e-5)


def test_full_model_learns_and_has_three_classes(trained):
    fitted, predictions = trained.model, trained.predictions
    assert fitted.stages[-1].numClasses == 3
    assert sorted(model.tier_labels(fitted)) == sorted(S.TIERS)
    assert evaluation.classification_metrics(predictions).first()["accuracy"] > 0.8


def test_importance(spark, trained):
    rows = evaluation.feature_importance(trained.model, spark).collect()
    assert len(rows) == 20 and rows[0]["feature"] in ("loudness", "loudness_energy")
    assert sum(r["importance"] for r in rows) == pytest.approx(1, abs=1e-4)


def test_same_seed_same_model(catalogue, trained):
    again = training.train_model(catalogue, training.FULL, **SMALL).model
    assert again.stages[-1].featureImportances == trained.model.stages[-1].featureImportances


def test_scoring(spark, catalogue, trained, tmp_path):
    fitted = trained.model
    requests = catalogue.select("track_id", *S.SCORE_DEFAULTS, "popularity_tier")
    holes = requests.withColumns({"tempo": F.lit(None).cast("double"), "genre_group": F.lit("Unseen")})
    scored = model.score_tracks(fitted, requests.unionByName(holes))
    assert scored.count() == 2 * catalogue.count()
    row = scored.selectExpr(
        "min(probabilities.Low + probabilities.Mid + probabilities.High) AS low",
        "max(probabilities.Low + probabilities.Mid + probabilities.High) AS high",
        """bool_and(confidence = greatest(probabilities.Low, probabilities.Mid, probabilities.High))
           AS top""",
    ).first()
    assert 99.7 <= row["low"] and row["high"] <= 100.3 and row["top"]
    for r in scored.select("popularity_tier", "message").distinct().collect():
        assert r["message"] == S.TIER_MESSAGES[r["popularity_tier"]]

    path = str(tmp_path / "model")
    fitted.write().overwrite().save(path)
    loaded = model.score_tracks(PipelineModel.load(path), requests)
    columns = ["track_id", "confidence", "popularity_tier"]
    assert sorted(loaded.select(columns).collect()) == sorted(
        model.score_tracks(fitted, requests).select(columns).collect()
    )


def test_compact_model_scores_unknown_genres(catalogue):
    result = training.train_model(catalogue, training.COMPACT, **SMALL)
    fitted, predictions, weights = result.model, result.predictions, result.weights
    assert evaluation.feature_names(fitted) == model.COMPACT_FEATURES
    assert weights.count() == 3
    assert evaluation.classification_metrics(predictions).first()["accuracy"] > 0.8
    requests = catalogue.select("track_id", *S.SCORE_DEFAULTS).withColumn("genre_group", F.lit("?"))
    assert model.score_tracks(fitted, requests).count() == catalogue.count()


def test_weights_may_come_from_all_rows(catalogue):
    frame = training.split_rows(catalogue).persist()
    counts = {
        weigh_all: training.train_on(frame, training.FULL, weigh_all, numTrees=1, maxDepth=1)
        .weights.agg(F.sum("class_count"))
        .first()[0]
        for weigh_all in (False, True)
    }
    assert counts[False] < counts[True] == catalogue.count()


def test_train_and_save(spark, catalogue, tmp_path):
    path = str(tmp_path / "run")
    training.train_and_save(catalogue, path, datetime(2024, 1, 1), **SMALL)
    report = spark.read.json(f"{path}/report").first()
    assert report["num_trees"] == 5 and report["max_depth"] == 4
    assert report["train_rows"] + report["test_rows"] == catalogue.count()
    assert sum(c["count"] for c in report["confusion_matrix"]) == report["test_rows"]
    assert len(report["feature_importance"]) == 20 and len(report["features"]) == 20
    assert set(report["class_weights"].asDict()) == set(S.TIERS)
    assert training.load_model(path).stages[-1].getNumTrees == 5


def test_published_forest_settings():
    forest = model.full_pipeline().getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSubsamplingRate()) == (300, 15, 0.8)
    assert model.compact_pipeline().getStages()[-1].getNumTrees() == 20
