"""Every operator as a named query over the sample catalogue."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import round_exact
from trackmart.operators import (
    artists,
    cleaning,
    evaluation,
    features,
    forest,
    marts,
    model,
    profiles,
    quality,
    search,
    splits,
    states,
)
from trackmart.plans import insight, publishing, refresh, training
from trackmart.plans.sample_splits import SPLITS
from trackmart.session import materialize, releasing, scratch_path
from trackmart.sinks import keyed, tables
from trackmart.sources import sample_tables as samples
from trackmart.sources.fingerprint import changed_parts, part_fingerprints, table_fingerprint
from trackmart.sources.tracks import read_tracks_csv

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Averages are published to six decimals here, so that the last bits of a
# floating-point sum do not decide a comparison between engines.
DIGITS = 6
ROW_ID = ["track_id", "tb1", "tb2", "tb3"]
MIN_ROWS = 1_000


def query(build: Query, name: str | None = None) -> Query:
    """Register a function of session and table folder."""
    _QUERIES[name or build.__name__] = build
    return build


def _on(source: Query):
    """Decorator registering functions of one source frame, under their own name by default."""

    def decorate(build: Callable[[DataFrame], DataFrame] | None = None, *, name: str | None = None):
        if build is None:
            return lambda b: decorate(b, name=name)
        query(lambda spark, folder: build(source(spark, folder)), name or build.__name__)
        return build

    return decorate


on_raw = _on(samples.tracks_raw)
on_unique = _on(samples.tracks_unique)
on_cleaned = _on(samples.tracks_cleaned)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# ------------------------------------------------------------------ sources, sinks


@on_raw(name="table_fingerprint")
def fingerprint(raw):
    return table_fingerprint(raw)


@on_raw
def csv_roundtrip(raw):
    """Raw tracks through CSV files whose first header field is blank."""
    path = scratch_path(raw.sparkSession, "tracks-csv")
    numbered = raw.drop(*samples.TIE_BREAKERS).select(F.lit(0).alias(""), "*")
    numbered.write.options(header=True, escape='"').csv(path)
    return read_tracks_csv(raw.sparkSession, path)


@on_cleaned
def partitioned_roundtrip(cleaned):
    path = scratch_path(cleaned.sparkSession, "tracks-by-year")
    tables.write_partitioned(cleaned, path)
    return cleaned.sparkSession.read.parquet(path)


def _early_and_raw(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = samples.tracks_raw(spark, folder)
    cleaned = cleaning.clean_unique(samples.tracks_unique(spark, folder))
    return cleaned.filter("year < 2012").select(raw.columns), raw


@query
def insert_if_absent(spark, folder):
    """Late tracks, copies included, into a table of early ones."""
    early, raw = _early_and_raw(spark, folder)
    merged = tables.insert_if_absent(
        raw.filter("year >= 2008").withColumn("origin", F.lit("inserted")),
        early.withColumn("origin", F.lit("existing")),
        tie_breakers=samples.TIE_BREAKERS,
    )
    return _day_as_text(merged)


@query
def keyed_append(spark, folder):
    """The same through commits to a stored table: a batch, its repetition, a second batch."""
    early, raw = _early_and_raw(spark, folder)
    root = scratch_path(spark, "keyed-tracks")
    early = early.withColumn("origin", F.lit("existing"))
    late = raw.filter("year >= 2008").withColumn("origin", F.lit("inserted"))
    schema = ", ".join(f"{name} {kind}" for name, kind in early.dtypes)
    keyed.create(spark, root, schema, "track_id")
    for batch, rows in (("early", early), ("late", late), ("late", late)):
        keyed.append_absent(rows, root, batch, samples.TIE_BREAKERS)
    return _day_as_text(keyed.read(spark, root))


def _day_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("tb4", F.col("tb4").cast("string"))


@on_raw
def coerced_tracks(raw):
    derived = cleaning.add_popularity_tier(cleaning.add_genre_group(raw))
    return cleaning.coerce_tracks(derived)


@on_raw
def key_violations(raw):
    return quality.key_violations(raw, "track_id")


@on_raw
def length_violations(raw):
    derived = cleaning.add_popularity_tier(cleaning.add_genre_group(raw))
    return quality.length_violations(derived, S.LENGTH_LIMITS["tracks"])


@on_cleaned
def conformance(cleaned):
    """Key and length conformance of what would be published as the detail table."""
    cleaned = cleaning.serving_projection(cleaned)
    return quality.conformance(cleaned, S.PRIMARY_KEYS["tracks"], S.LENGTH_LIMITS["tracks"])


# ------------------------------------------------------------------ row operators


@on_raw
def drop_nulls(raw):
    return cleaning.drop_nulls(raw).select(*ROW_ID, *S.NOT_NULL_COLUMNS)


@on_raw
def fix_sentinel(raw):
    return cleaning.fix_sentinel(raw).select(*ROW_ID, "key")


@on_raw
def outlier_filter(raw):
    kept = cleaning.outlier_filter(raw)
    return kept.select(*ROW_ID, "duration_ms", "tempo", "loudness", "popularity")


@on_raw
def genre_group(raw):
    return cleaning.add_genre_group(raw).select(*ROW_ID, "genre", "genre_group")


@on_raw(name="popularity_tier")
def tiers(raw):
    return cleaning.add_popularity_tier(raw).select(*ROW_ID, "popularity", "popularity_tier")


@on_unique
def dedupe_tracks(unique):
    return _day_as_text(unique)


@on_cleaned
def serving_projection(cleaned):
    return cleaning.serving_projection(cleaned)


@on_cleaned
def engineered_features(cleaned):
    made = features.engineered_features(features.training_rows(cleaned))
    # Logarithms may differ in their last bits between engines.
    made = made.withColumn("log_duration", round_exact(F.col("log_duration"), DIGITS))
    return made.select("track_id", *S.ENGINEERED_FEATURES)


@on_cleaned
def genre_code(cleaned):
    return features.add_genre_code(cleaned).select("track_id", "genre_group", "genre_idx")


def _requests(cleaned: DataFrame) -> DataFrame:
    """Scoring requests: cleaned tracks with some inputs left out."""
    gaps = {"energy": 7, "tempo": 11, "duration_ms": 13, "genre_group": 17}
    left_out = {
        c: F.when(F.col("duration_ms") % n != 0, F.col(c)) for c, n in gaps.items()
    }
    return cleaned.select("track_id", *S.SCORE_DEFAULTS).withColumns(left_out)


@on_cleaned
def score_defaults(cleaned):
    filled = features.score_defaults(_requests(cleaned).drop("liveness", "speechiness"))
    return filled.select("track_id", *S.SCORE_DEFAULTS)


@on_cleaned
def input_domain_check(cleaned):
    checked = features.input_domain_check(_requests(cleaned))
    return checked.select("track_id", F.array_join("violations", ",").alias("violations"))


# ------------------------------------------------------------------ quality


@on_raw
def validate_raw(raw):
    return quality.validate_raw(raw, MIN_ROWS)


@on_cleaned
def validate_cleaned(cleaned):
    return quality.validate_cleaned(cleaned, MIN_ROWS)


@query
def validation_summary(spark, folder):
    raw, cleaned = samples.tracks_raw(spark, folder), samples.tracks_cleaned(spark, folder)
    checks = quality.validate_raw(raw, MIN_ROWS).unionByName(
        quality.validate_cleaned(cleaned, MIN_ROWS)
    )
    return quality.validation_summary(checks)


@on_raw
def column_profile(raw):
    return quality.column_profile(raw, "track_id")


@on_raw
def cleaning_audit(raw):
    return cleaning.cleaning_audit(raw, tie_breakers=samples.TIE_BREAKERS)


# ------------------------------------------------------------------ marts


@on_cleaned
def music_trends(cleaned):
    return marts.music_trends(cleaned, DIGITS)


@on_cleaned
def genre_stats(cleaned):
    return marts.genre_stats(cleaned, DIGITS)


@on_cleaned
def mood_map(cleaned):
    return marts.mood_map(cleaned, DIGITS)


def _refreshed_states(cleaned: DataFrame) -> DataFrame:
    """States stored from a catalogue in which one year differed, then refreshed."""
    root = scratch_path(cleaned.sparkSession, "mart-states")
    with releasing(cleaned.sparkSession):
        stored = materialize(cleaned.select("*"), "state-tracks")
    refresh.refresh_states(stored.where("NOT (year = 2007 AND energy > 0.5)"), root)
    refresh.refresh_states(stored, root)
    return refresh.read_states(cleaned.sparkSession, root)


@on_cleaned
def trends_from_states(cleaned):
    return states.music_trends(_refreshed_states(cleaned), DIGITS)


@on_cleaned
def artist_stats_from_states(cleaned):
    return states.artist_stats(_refreshed_states(cleaned))


@on_cleaned
def genre_stats_in_order(cleaned):
    """The published genre statistics as they are read, with their places in that order."""
    spark, root = cleaned.sparkSession, scratch_path(cleaned.sparkSession, "marts")
    rounded = marts.genre_stats(cleaned, DIGITS)
    tables.publish(rounded, f"{root}/genre_stats", "v1", datetime(2024, 1, 1))
    in_order = publishing.read_mart(spark, root, "genre_stats")
    # One row per genre group: eight at most.
    return in_order.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


@on_cleaned
def changed_years(cleaned):
    """Years whose fingerprint differs after some tracks were left out."""
    now = cleaned.where("year <> 2003")
    before = cleaned.where("year <> 2005 AND NOT (year = 2010 AND loudness < -30)")
    return changed_parts(part_fingerprints(now), part_fingerprints(before))


@on_cleaned
def genre_distribution(cleaned):
    return marts.genre_distribution(cleaned)


@on_cleaned
def label_distribution(cleaned):
    return marts.label_distribution(cleaned)


@on_cleaned
def trend_kpis(cleaned):
    return marts.trend_kpis(marts.music_trends(cleaned, DIGITS))


@on_cleaned
def top_genre(cleaned):
    return marts.top_genre(marts.genre_stats(cleaned, DIGITS))


@on_cleaned
def genre_radar(cleaned):
    return marts.genre_radar(marts.genre_stats(cleaned, DIGITS))


# ------------------------------------------------------------------ artists


@on_cleaned
def artist_stats(cleaned):
    return artists.artist_stats(cleaned)


@on_cleaned
def artist_search(cleaned):
    return artists.artist_search(artists.artist_stats(cleaned), "CUSTOMER#0000001")


@on_cleaned
def artist_search_indexed(cleaned):
    """The same search through a stored posting table of trigrams."""
    stats = materialize(artists.artist_stats(cleaned), "artist-stats")
    path = scratch_path(cleaned.sparkSession, "name-postings")
    search.write_postings(stats, path)
    return search.indexed_search(stats, search.read_postings(cleaned.sparkSession, path), "CUSTOMER#0000001")


@on_cleaned
def name_postings(cleaned):
    """How many names have each trigram."""
    rows = search.postings(artists.artist_stats(cleaned))
    return rows.groupBy("trigram").agg(F.count(F.lit(1)).alias("names"))


@on_cleaned
def artist_detail(cleaned):
    return artists.artist_detail(artists.artist_stats(cleaned))


@on_cleaned
def artist_by_name(cleaned):
    return artists.artist_detail(artists.artist_stats(cleaned), "CUSTOMER#000000042")


@on_cleaned
def top_tracks_per_artist(cleaned):
    return artists.top_tracks_per_artist(cleaned).withColumn("rank", F.col("rank").cast("bigint"))


@on_cleaned
def primary_genre(cleaned):
    return artists.primary_genre(artists.artist_stats(cleaned)).select(
        "artist_key", "artist_name", "genre_group", "track_count"
    )


@on_cleaned
def artist_report(cleaned):
    report = artists.artist_report(cleaned, samples.stored_profiles(cleaned))
    entry = lambda t: F.concat_ws("|", t["track_name"], t["popularity"], t["year"])
    return report.withColumns(
        {
            "top_tracks": F.array_join(F.transform("top_tracks", entry), ";"),
            "similar_artists": F.array_join("similar_artists", ";"),
            "generated_at": _stamp(),
        }
    )


def _stamp():
    return F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss")


@on_cleaned
def profiles_cached(cleaned):
    return artists.profiles_cached(_artist_names(cleaned), samples.stored_profiles(cleaned))


@on_cleaned
def profiles_missing(cleaned):
    return artists.profiles_missing(_artist_names(cleaned), samples.stored_profiles(cleaned))


def _artist_names(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("artist_name").distinct()


@query
def artists_not_found(spark, folder):
    """Names of all customers, once per order, against artists of the catalogue."""
    orders, customers = (samples.table(spark, folder, t) for t in ("orders", "customer"))
    requests = orders.join(customers, F.expr("o_custkey = c_custkey")).select(
        F.upper("c_name").alias("artist_name")
    )
    return artists.artists_not_found(requests, samples.tracks_cleaned(spark, folder))


@on_cleaned
def artist_radar(cleaned):
    return artists.artist_radar(artists.artist_stats(cleaned))


@on_cleaned
def audio_fingerprint(cleaned):
    return artists.audio_fingerprint(artists.artist_stats(cleaned))


# ------------------------------------------------------------------ profiles


@on_cleaned
def profile_prompts(cleaned):
    return profiles.profile_prompts(artists.artist_overview(cleaned))


@on_cleaned
def pending_prompts(cleaned):
    return insight.pending_prompts(cleaned, samples.stored_profiles(cleaned))


@on_cleaned
def parse_replies(cleaned):
    known = artists.primary_genre(artists.artist_stats(cleaned))
    parsed = profiles.parse_replies(samples.raw_replies(cleaned), known)
    return parsed.withColumn("generated_at", _stamp())


@on_cleaned
def rejected_replies(cleaned):
    known = artists.primary_genre(artists.artist_stats(cleaned))
    parsed = profiles.parse_replies(samples.raw_replies(cleaned), known)
    return profiles.quarantine(parsed).withColumn("generated_at", _stamp())


@on_cleaned
def profile_upsert(cleaned):
    parsed = insight.read_replies(artists.artist_stats(cleaned), samples.raw_replies(cleaned))
    parsed = materialize(parsed, "parsed-replies")  # a merge and its rejects both read them
    merged = insight.merge_replies(samples.stored_profiles(cleaned), parsed)
    return merged.profiles.withColumn("generated_at", _stamp())


@on_cleaned
def profile_upsert_by_bucket(cleaned):
    """The same merge into a bucketed table, of which only touched buckets are rewritten."""
    spark, root = cleaned.sparkSession, scratch_path(cleaned.sparkSession, "keyed-profiles")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.ARTIST_PROFILES)
    keyed.create(spark, root, schema, "artist_name")
    keyed.append_absent(samples.stored_profiles(cleaned), root, "stored")
    parsed = insight.read_replies(artists.artist_stats(cleaned), samples.raw_replies(cleaned))
    keyed.upsert(materialize(profiles.accepted(parsed), "replies"), root, "replies", profiles.profile_upsert)
    return keyed.read(spark, root).withColumn("generated_at", _stamp())


@on_cleaned
def similar_artist_links(cleaned):
    known = artists.primary_genre(artists.artist_stats(cleaned))
    return profiles.similar_artist_links(samples.stored_profiles(cleaned), known)


@on_cleaned
def similar_artists_roundtrip(cleaned):
    stored = samples.stored_profiles(cleaned).select("artist_name", "similar_artists")
    decoded = profiles.decode_similar(stored)
    return profiles.encode_similar(
        decoded.withColumn("similar_count", F.size("similar_artists").cast("bigint"))
    )


@query
def event_props_json(spark, folder):
    """Event properties decoded to a column and encoded again."""
    events = samples.table(spark, folder, "events")
    props = F.from_json("props", "k int")
    return events.select(
        "event_id", props["k"].cast("bigint").alias("k"), F.to_json(props).alias("props_json")
    )


# ------------------------------------------------------------------ model inputs


@on_cleaned
def hash_split(cleaned):
    return splits.hash_split(cleaned).select("track_id", "split")


@on_cleaned
def stratified_split(cleaned):
    return splits.stratified_split(cleaned).select("track_id", "popularity_tier", "split")


@on_cleaned
def class_weights(cleaned):
    return splits.class_weights(cleaned)


@on_cleaned
def class_weights_train(cleaned):
    train = splits.stratified_split(cleaned).filter(F.col("split") == splits.TRAIN)
    weights = splits.class_weights(train, digits=None)
    return weights.withColumn("class_weight", round_exact(F.col("class_weight"), DIGITS))


@on_cleaned
def genre_index(cleaned):
    indexed = model.genre_indexer().fit(cleaned).transform(cleaned)
    return indexed.select("track_id", "genre_group", "genre_idx")


@on_cleaned
def label_index(cleaned):
    indexed = model.label_indexer().fit(cleaned).transform(cleaned)
    return indexed.select("track_id", "popularity_tier", "label")


@on_cleaned
def standardised(cleaned):
    rows = features.training_rows(cleaned).select("track_id", *S.TRAINING_COLUMNS)
    rows = materialize(rows, "standardised")  # fitting reads its input several times
    scaled = Pipeline(stages=model.scaling_stages()).fit(rows).transform(rows)
    rounded = F.transform(vector_to_array("features"), lambda v: round_exact(v, 4))
    scores = scaled.select("track_id", rounded.alias("scores"))
    return scores.select(
        "track_id", *[F.col("scores")[i].alias(f"z_{c}") for i, c in enumerate(model.FULL_FEATURES)]
    )


# ------------------------------------------------------------------ evaluation


def _rule_predictions(cleaned: DataFrame) -> DataFrame:
    """Tier guessed from loudness alone: deterministic on every engine."""
    guess = F.when(F.col("loudness") > -10, "High").when(F.col("loudness") > -25, "Mid")
    return cleaned.select(
        F.col("popularity_tier").alias("label"), guess.otherwise("Low").alias("prediction")
    )


@on_cleaned
def confusion_matrix(cleaned):
    return evaluation.confusion_matrix(_rule_predictions(cleaned))


@on_cleaned
def confusion_dense(cleaned):
    return evaluation.confusion_dense(_rule_predictions(cleaned), S.TIERS)


@on_cleaned
def classification_metrics(cleaned):
    return evaluation.classification_metrics(_rule_predictions(cleaned))


# ------------------------------------------------------------------ models
#
# Trees depend on the partition layout, so these report what does not: who was trained
# and scored, with what weights and inputs, and whether the results hold together.


@functools.lru_cache(maxsize=2)
def _trained(spark: SparkSession, folder: str, kind: str) -> training.Trained:
    """The model of a folder, fitted on all its training rows once for the queries that need it."""
    tracks = samples.tracks_cleaned(spark, folder)
    return training.train_model(tracks, kind)


def _tier_summary(result: training.Trained) -> DataFrame:
    tier = "popularity_tier"
    trained = result.train.groupBy(tier).agg(F.count(F.lit(1)).alias("train_rows"))
    known = F.col("prediction").isin([float(n) for n in range(len(S.TIERS))])
    # The trees see every test row once.
    predictions = materialize(result.predictions.select(tier, "label", "prediction"), "predictions")
    tested = predictions.groupBy(tier).agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(known).alias("scored_rows")
    )
    weights = result.weights.select(tier, round_exact(F.col("class_weight"), DIGITS).alias("class_weight"))
    metrics = evaluation.classification_metrics(predictions).first()
    sound = all(0 < m <= 1 for m in metrics) and metrics["accuracy"] == metrics["weighted_recall"]
    joined = trained.join(tested, tier, "full").join(weights, tier, "full")
    return joined.withColumn("metrics_sound", F.lit(sound))


@query
def train_tier_model(spark, folder):
    return _tier_summary(_trained(spark, folder, training.FULL))


@query
def train_compact_model(spark, folder):
    return _tier_summary(_trained(spark, folder, training.COMPACT))


@query
def feature_importance(spark, folder):
    found = evaluation.feature_importance(_trained(spark, folder, training.FULL).model, spark)
    total = F.sum("importance").over(Window.partitionBy())  # one row per feature
    return found.select(
        "feature",
        F.col("importance").between(0, 1).alias("is_share"),
        (F.abs(total - 1) < 1e-4).alias("shares_sum_to_one"),
    )


@query
def score_tracks(spark, folder):
    requests = _requests(samples.tracks_cleaned(spark, folder))
    scored = model.score_tracks(_trained(spark, folder, training.FULL).model, requests)
    shares = [F.col(f"probabilities.{t}") for t in S.TIERS]
    own = F.coalesce(*[F.when(F.col("popularity_tier") == t, share) for t, share in zip(S.TIERS, shares)])
    message = F.coalesce(*[F.when(F.col("popularity_tier") == t, F.lit(m)) for t, m in S.TIER_MESSAGES.items()])
    return scored.select(
        *requests.columns,
        (F.abs(sum(shares[1:], shares[0]) - 100) < 0.25).alias("shares_sum_to_100"),
        ((own == F.greatest(*shares)) & (own == F.col("confidence"))).alias("tier_is_likeliest"),
        (F.col("message") == message).alias("message_fits"),
    )


# The small committed forest, refitted to the training rows of the given tables: its results
# depend on the rows alone, so scores, importances and metrics themselves are compared.


@functools.lru_cache(maxsize=2)
def _split_tracks(spark: SparkSession, folder: str) -> DataFrame:
    tracks = samples.tracks_cleaned(spark, folder)
    return materialize(features.add_genre_code(training.split_rows(tracks)), "forest-rows")


def _refitted(spark: SparkSession, folder: str) -> DataFrame:
    train = _split_tracks(spark, folder).filter(F.col("split") == splits.TRAIN)
    weights = {r["popularity_tier"]: r["class_weight"] for r in splits.class_weights(train).collect()}
    places = {name: n for n, name in enumerate(model.COMPACT_FEATURES)}
    inner = [(tree, node, places[name], *rest) for tree, node, name, *rest in SPLITS]
    nodes = forest.structure(spark, inner, len(S.TIERS))
    return materialize(forest.refit(nodes, train, model.COMPACT_FEATURES, S.TIERS, weights), "forest-nodes")


@query
def refitted_forest(spark, folder):
    nodes = _refitted(spark, folder)
    names = F.array(*map(F.lit, model.COMPACT_FEATURES))
    weights = [round_exact(F.get("weights", F.lit(n)), DIGITS).alias(f"weight_{t.lower()}") for n, t in enumerate(S.TIERS)]
    gained = forest.gains(nodes).select("tree", "node", round_exact(F.col("gain"), DIGITS).alias("gain"))
    return nodes.join(gained, forest.NODE, "left").select(
        "tree", "node", F.get(names, "feature").alias("feature"), "threshold", *weights, "gain"
    )


@query
def forest_importance(spark, folder):
    return forest.importance(_refitted(spark, folder), model.COMPACT_FEATURES)


@query
def forest_scores(spark, folder):
    """Tier, confidence, share of each tier and message of every request."""
    requests = features.add_genre_code(features.score_defaults(_requests(samples.tracks_cleaned(spark, folder))))
    scored = forest.tier_scores(_refitted(spark, folder), requests, model.COMPACT_FEATURES, S.TIERS)
    shares = [f"share_{t.lower()}" for t in S.TIERS]
    return scored.select("track_id", "tier", "confidence", *shares, "message")


def _forest_confusion(spark: SparkSession, folder: str) -> DataFrame:
    test = _split_tracks(spark, folder).filter(F.col("split") == splits.TEST)
    predicted = forest.predictions(_refitted(spark, folder), test, model.COMPACT_FEATURES, S.TIERS)
    return evaluation.confusion_matrix(predicted, "popularity_tier", "prediction")


@query
def forest_confusion(spark, folder):
    return _forest_confusion(spark, folder)


@query
def forest_report(spark, folder):
    """Metrics on the test rows, the rows they rest on, and the leading feature."""
    cells = materialize(_forest_confusion(spark, folder), "forest-confusion")
    metrics = evaluation.metrics_from_confusion(cells, "popularity_tier", "prediction")
    leading = forest.importance(_refitted(spark, folder), model.COMPACT_FEATURES).limit(1)
    train = _split_tracks(spark, folder).filter(F.col("split") == splits.TRAIN)
    return metrics.select(
        "*",
        train.select(F.count(F.lit(1))).scalar().alias("train_rows"),
        cells.select(F.sum("row_count")).scalar().alias("test_rows"),
        leading.select("feature").scalar().alias("leading_feature"),
        leading.select("importance").scalar().alias("leading_importance"),
    )


@query
def model_report(spark, folder):
    result = _trained(spark, folder, training.FULL)
    report = evaluation.model_report(
        result.model, result.predictions, result.weights, result.train.count(), datetime(2024, 1, 1)
    )
    cells = F.aggregate("confusion_matrix", F.lit(0).cast("bigint"), lambda n, c: n + c["count"])
    return report.select(
        "label",
        F.array_join("features", ",").alias("features"),
        "num_trees",
        "max_depth",
        "subsampling_rate",
        *[F.col("class_weights")[t].alias(f"weight_{t.lower()}") for t in S.TIERS],
        "train_rows",
        "test_rows",
        cells.alias("confusion_total"),
        F.size("feature_importance").alias("importances"),
        F.col("metrics.accuracy").between(0, 1).alias("is_share"),
        (F.col("metrics.accuracy") == F.col("metrics.weighted_recall")).alias("metrics_agree"),
    )
