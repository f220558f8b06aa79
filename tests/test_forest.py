"""Forests as node tables: against the library's own model, refitted, scored; stored models."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.frames import varied
from trackmart import schemas as S
from trackmart.operators import cleaning, evaluation, features, forest, model, splits
from trackmart.plans import registry, training
from trackmart.session import scratch_path

SMALL = {"numTrees": 6, "maxDepth": 5}
TINY = {"numTrees": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def catalogue(spark):
    return cleaning.clean(varied(spark)).persist()


@pytest.fixture(scope="module", params=[training.FULL, training.COMPACT])
def fitted(request, catalogue):
    return training.train_model(catalogue, request.param, **SMALL)


@pytest.fixture(scope="module")
def nodes(fitted, tmp_path_factory):
    return forest.nodes_of(fitted.model, str(tmp_path_factory.mktemp("forest") / "model")).persist()


def unpacked(predictions, n):
    values = predictions.withColumn("values", vector_to_array("features"))
    shares = vector_to_array("probability").alias("probability")
    return values.select("prediction", shares, *[F.col("values")[i].alias(f"x{i}") for i in range(n)])


def test_scores_equal_the_model(fitted, nodes):
    names = evaluation.feature_names(fitted.model)
    rows = unpacked(fitted.predictions, len(names))
    columns = [f"x{i}" for i in range(len(names))]
    scored = rows.withColumn("shares", forest.leaf_shares(nodes, columns, 3))
    gaps = [F.abs(F.col("shares")[i] - F.col("probability")[i]) for i in range(3)]
    assert scored.agg(F.max(F.greatest(*gaps))).first()[0] < 1e-12
    labels = model.tier_labels(fitted.model)
    predicted = forest.predictions(nodes, rows.drop("prediction"), columns, labels, digits=9)
    ours = predicted.groupBy("prediction").count().collect()
    index = F.get(F.array(*map(F.lit, labels)), F.col("prediction").cast("int")).alias("prediction")
    assert sorted(ours) == sorted(rows.select(index).groupBy("prediction").count().collect())


def test_importance_equals_the_model(spark, fitted, nodes):
    ours = forest.importance(nodes, evaluation.feature_names(fitted.model)).collect()
    theirs = dict(map(tuple, evaluation.feature_importance(fitted.model, spark).collect()))
    assert {r.feature: r.importance for r in ours} == pytest.approx(theirs, abs=2e-6)
    assert [r.importance for r in ours] == sorted((r.importance for r in ours), reverse=True)


SPLITS = [(0, 0, 0, 10.0, 1, 2), (0, 2, 1, 0.5, 3, 4), (1, 0, 1, 0.25, 1, 2)]
ROWS = [(5.0, 0.1, "Low"), (10.0, 0.9, "Mid"), (11.0, 0.5, "Mid"), (12.0, 0.6, "High"), (None, 0.2, "Low"),
        (float("nan"), 0.9, "High"), (5.0, 0.1, "Other")]


def small(spark):
    return forest.structure(spark, SPLITS, 3), spark.createDataFrame(ROWS, "x double, y double, popularity_tier string")


def test_refit_by_hand(spark):
    nodes, rows = small(spark)
    assert nodes.count() == 8
    done = forest.refit(nodes, rows, ["x", "y"], S.TIERS, {"Low": 1.0, "Mid": 2.0, "High": 4.0})
    got = {(r.tree, r.node): r.weights for r in done.collect()}
    # Null and NaN are above a threshold; rows of another label do not count.
    assert got == {
        (0, 0): [2, 4, 8], (0, 1): [1, 2, 0], (0, 2): [1, 2, 8], (0, 3): [1, 2, 0], (0, 4): [0, 0, 8],
        (1, 0): [2, 4, 8], (1, 1): [2, 0, 0], (1, 2): [0, 4, 8],
    }
    scored = forest.predictions(done, rows.limit(1), ["x", "y"], S.TIERS).first()
    assert scored.shares == pytest.approx([(1 / 3 + 1) / 2, (2 / 3) / 2, 0], abs=1e-6) and scored.prediction == "Low"
    gained = {(r.tree, r.node): r.gain for r in forest.gains(done).collect()}
    gini = lambda *w: 1 - sum(x * x for x in w) / sum(w) ** 2
    assert gained[1, 0] == pytest.approx(gini(2, 4, 8) - (0 * 2 + gini(0, 4, 8) * 12) / 14)


def test_refit_without_rows(spark):
    nodes, rows = small(spark)
    done = forest.refit(nodes, rows.limit(0), ["x", "y"], S.TIERS, dict.fromkeys(S.TIERS, 1.0))
    assert all(r.weights == [0, 0, 0] for r in done.collect())
    scored = forest.predictions(done, rows, ["x", "y"], S.TIERS).first()
    assert scored.shares == [0, 0, 0] and scored.prediction == "Low"
    assert all(r.importance == 0 for r in forest.importance(done, ["x", "y"]).collect())


def test_nodes_that_are_no_trees_are_refused(spark):
    for broken, message in (
        ([(0, 0, 0, 1.0, 1, 3)], "numbered"),
        ([(0, 0, 0, 1.0, 1, 1)], "two parents"),
    ):
        with pytest.raises(ValueError, match=message):
            forest.walkable(forest.structure(spark, broken, 3))


def test_too_large_a_forest_is_refused(spark, monkeypatch):
    monkeypatch.setattr(forest, "MOST_NODES", 3)
    with pytest.raises(ValueError, match="at most"):
        forest.walkable(small(spark)[0])


def test_tier_scores_of_requests(spark, catalogue, nodes, fitted):
    if model.COMPACT_FEATURES != evaluation.feature_names(fitted.model):
        pytest.skip("the full model's inputs are standardised")
    requests = features.add_genre_code(features.score_defaults(catalogue.select("track_id", *S.SCORE_DEFAULTS)))
    labels = model.tier_labels(fitted.model)
    ours = forest.tier_scores(nodes, requests, model.COMPACT_FEATURES, labels)
    theirs = model.score_tracks(fitted.model, requests.drop("genre_idx"))
    joined = ours.join(theirs.select("track_id", "popularity_tier", F.col("confidence").alias("c"), "probabilities"), "track_id")
    wrong = joined.where(
        (F.col("tier") != F.col("popularity_tier")) | (F.abs(F.col("confidence") - F.col("c")) > 0.1001)
        | (F.abs(F.col("share_low") - F.col("probabilities.Low")) > 0.1001)
    )
    assert joined.count() == catalogue.count() and wrong.isEmpty()


# ------------------------------------------------------------------ fitting sample


def test_fitting_rows_do_not_depend_on_layout(spark):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("track_id"))
    keys = lambda df: sorted(r[0] for r in df.collect())
    first = keys(splits.first_by_hash(rows, 700))
    assert first == keys(splits.first_by_hash(rows.repartition(13), 700)) and len(first) == 700
    expected = rows.orderBy(F.md5("track_id")).limit(700)
    assert first == keys(expected)
    assert splits.first_by_hash(rows, 5000).count() == 5000 == splits.first_by_hash(rows, 9000).count()


def test_a_repeated_key_is_taken_whole_or_not_at_all(spark):
    rows = spark.createDataFrame([("hot",)] * 600 + [(f"k{n}",) for n in range(900)], "track_id string")
    for n in (100, 650, 1200):
        got = splits.first_by_hash(rows, n, prefix=1)
        assert got.count() <= n
        assert got.where("track_id = 'hot'").count() in (0, 600)
    assert splits.first_by_hash(rows, 0).count() == 0


def test_fitting_rows_are_spread_over_the_cores(spark, catalogue):
    spread = training.spread(catalogue.select("track_id", "year"))
    sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism
    assert max(sizes) < 3 * catalogue.count() / len(sizes)


def test_trees_grown_in_parts_make_one_forest(spark, catalogue, tmp_path):
    frame = training.split_rows(catalogue, training.COMPACT)
    rows = splits.add_class_weights(frame, splits.class_weights(frame)).persist()
    grown = [
        forest.fit_in_parts(model.compact_pipeline(numTrees=7, maxDepth=3), rows.repartition(n), str(tmp_path / f"p{n}"), 3)
        for n in (2, 5)
    ]
    for fitted in grown:
        assert fitted.stages[-1].getNumTrees == 7 and fitted.stages[-1].numClasses == 3
        assert sum(fitted.stages[-1].featureImportances.toArray()) == pytest.approx(1)
    # The same trees whatever the layout of the rows; they differ from part to part.
    text = [f.stages[-1].toDebugString.split("\n", 1)[1] for f in grown]
    assert text[0] == text[1]
    trees = text[0].split("Tree ")[1:]
    assert len(trees) == 7 and len({t.split("\n", 1)[1] for t in trees}) > 4
    found = [sorted(r[0] for r in f.transform(rows).select("prediction").collect()) for f in grown]
    assert found[0] == found[1] and len(found[0]) == catalogue.count()


@pytest.mark.parametrize("kind", [training.FULL, training.COMPACT])
def test_registered_models_are_fitted_on_all_training_rows(spark, catalogue, monkeypatch, kind):
    copies = catalogue.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(60))))
    many = copies.withColumn("track_id", F.concat_ws("-", "track_id", "copy")).drop("copy")
    monkeypatch.setattr(registry.samples, "tracks_cleaned", lambda *_: many)
    for settings in (model.FULL_FOREST, model.COMPACT_FOREST):
        monkeypatch.setitem(settings, "numTrees", 3)
        monkeypatch.setitem(settings, "maxDepth", 2)
    result = registry._trained.__wrapped__(spark, "any", kind)
    rows = result.train.count()
    assert rows > 11_000
    weights = {r["popularity_tier"]: r["class_weight"] for r in result.weights.collect()}
    each = [weights[t] for t in model.tier_labels(result.model)]
    path = scratch_path(spark, "all-rows")
    for root in forest.nodes_of(result.model, path).where("node = 0").collect():
        bagged = sum(w / one for w, one in zip(root["weights"], each))
        assert bagged == pytest.approx(rows * result.model.stages[-1].getSubsamplingRate(), rel=0.05)


def test_many_rows_are_fitted_in_more_tasks_and_fits(spark, catalogue, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "ROWS_A_TASK", 150)
    monkeypatch.setattr(forest, "TREES_A_FIT", 2)
    frame = training.split_rows(catalogue, training.COMPACT)
    rows = splits.add_class_weights(frame, splits.class_weights(frame)).persist()
    build = model.compact_pipeline(numTrees=5, maxDepth=3)
    found = [forest.fit_in_parts(build, rows.repartition(n), str(tmp_path / f"p{n}"), 1) for n in (2, 5)]
    texts = [f.stages[-1].toDebugString.split("\n", 1)[1] for f in found]
    assert texts[0] == texts[1] and found[0].stages[-1].getNumTrees == 5
    assert len(list(tmp_path.glob("p2/part-*"))) == 3


# ------------------------------------------------------------------ stored models


def train(catalogue, root, day, **settings):
    training.train_and_save(catalogue, root, datetime(2024, 1, day), training.COMPACT, **{**TINY, **settings})


def test_a_scorer_sees_the_old_model_or_the_new(spark, catalogue, tmp_path):
    root = str(tmp_path / "compact")
    with pytest.raises(FileNotFoundError):
        training.load_model(root)
    train(catalogue, root, 1)
    old = training.load_model(root, training.COMPACT)
    before = old.transform(features.score_defaults(catalogue.limit(5)).drop("popularity_tier"))
    train(catalogue, root, 2, numTrees=3)
    assert training.load_model(root).stages[-1].getNumTrees == 3
    versions = sorted(p.name for p in (Path(root) / "snapshots").iterdir())
    assert len(versions) == 2 and before.count() == 5
    assert training.load_model(root, version=versions[0]).stages[-1].getNumTrees == 2


def test_an_unfinished_model_is_not_current(spark, catalogue, tmp_path, monkeypatch):
    root = str(tmp_path / "compact")
    train(catalogue, root, 1)
    with monkeypatch.context() as broken:
        broken.setattr(training, "announce", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            train(catalogue, root, 2, numTrees=3)
    assert training.load_model(root).stages[-1].getNumTrees == 2


def test_a_model_that_is_not_as_signed_is_refused(spark, catalogue, tmp_path):
    root = str(tmp_path / "compact")
    train(catalogue, root, 1)
    with pytest.raises(training.ModelMismatch, match="not a full one"):
        training.load_model(root, training.FULL)
    folder = next((Path(root) / "snapshots").iterdir()) / "signature"
    signed = json.loads(spark.read.text(str(folder)).first()[0])
    for change in ({"labels": ["Low"]}, {"settings": {**signed["settings"], "num_trees": 9}}, {"features": ["x"]}):
        row = spark.createDataFrame([(json.dumps({**signed, **change}),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(str(folder))
        with pytest.raises(training.ModelMismatch, match=next(iter(change))):
            training.load_model(root)


def test_batch_scores_are_the_model_s_to_the_last_bit(fitted, catalogue):
    rows = features.training_rows(catalogue)
    columns = [vector_to_array("probability").alias("p"), "prediction"]
    ours, theirs = forest.model_scores(fitted.model, rows), fitted.model.transform(rows)
    assert "MapInArrow" in ours._jdf.queryExecution().executedPlan().toString()
    assert sorted(ours.select("track_id", *columns).collect()) == sorted(theirs.select("track_id", *columns).collect())
    assert "MapInArrow" in fitted.predictions._jdf.queryExecution().executedPlan().toString()


def test_spelled_out_trees_do_what_walked_ones_do(spark, catalogue, nodes, fitted, monkeypatch):
    names = evaluation.feature_names(fitted.model)
    vector = vector_to_array("features")
    rows = fitted.predictions.select("track_id", "popularity_tier", *[vector[i].alias(c) for i, c in enumerate(names)])
    holes = {names[0]: F.lit(None).cast("double"), names[1]: F.lit(float("nan"))}
    rows = rows.unionByName(rows.withColumns(holes))

    def found():
        shares = rows.select("track_id", forest.leaf_shares(nodes, names, 3).alias("shares"))
        counts = forest.visits(nodes, rows, names, "popularity_tier")
        return shares, counts

    monkeypatch.setattr(forest, "MOST_SPELLED_OUT", 10_000)
    ours = found()
    assert not any("lambda" in f._jdf.queryExecution().executedPlan().toString() for f in ours)
    monkeypatch.setattr(forest, "MOST_SPELLED_OUT", 0)
    for a, b in zip(ours, found()):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
