"""Plan shapes and hot keys: what must hold for tables far larger than these."""

import pytest
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions.joins import salted_left_join
from trackmart.operators import artists, cleaning, marts, quality
from trackmart.plans import registry
from trackmart.sources import sample_tables as samples

FOLDER = "/root/testdata/sf0.001"
SLOW = {"train_tier_model", "train_compact_model", "feature_importance", "score_tracks", "model_report"}
# Broadcasts of one row per class, or of a list of hot keys of limited length.
BOUNDED = {
    "stratified_split",
    "class_weights_train",
    "parse_replies",
    "rejected_replies",
    "profile_upsert",
    "similar_artist_links",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def large_tables(spark):
    """No automatic broadcasts, as if no table were small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(set(registry.registered()) - SLOW))
def test_no_plan_pairs_rows_or_broadcasts_unbounded_sides(large_tables, name):
    text = plan(registry.registered()[name](large_tables, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "ArrowEval" not in text
    if name not in BOUNDED:
        assert "BroadcastExchange" not in text


@pytest.mark.parametrize(
    "build",
    [
        cleaning.dedupe,
        lambda df: artists.top_tracks_per_artist(df),
        lambda df: artists.primary_genre(artists.artist_stats(cleaning.add_genre_group(df))),
    ],
)
def test_ranked_groups_are_cut_before_the_shuffle(spark, build):
    text = plan(build(samples.tracks_raw(spark, FOLDER)))
    final, partial = text.index(", Final"), text.index(", Partial")
    assert "Exchange hashpartitioning" in text[final:partial]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "tracks")
    samples.tracks_cleaned(spark, FOLDER).write.partitionBy("year").parquet(path)
    return spark.read.parquet(path)


def test_marts_read_only_their_columns(stored):
    text = plan(marts.mood_map(stored))
    assert "ReadSchema: struct<energy:double,valence:double,genre_group:string>" in text
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


def test_value_filters_reach_the_reader(stored):
    text = plan(cleaning.outlier_filter(cleaning.drop_nulls(stored)))
    for pushed in ("GreaterThan(duration_ms,30000)", "LessThan(loudness,0.0)", "IsNotNull(genre)"):
        assert pushed in text


def test_search_filters_below_the_aggregate(stored):
    text = plan(artists.artist_search(artists.artist_stats(stored), "x"))
    assert "TakeOrderedAndProject" in text
    assert text.index("HashAggregate") < text.index("Contains(lower(artist_name")


def test_checks_shuffle_keys_only(stored):
    text = plan(quality.validate_cleaned(stored, 1))
    keyed = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keyed) == 1 and "track_id" in keyed[0]


def test_report_gathers_without_a_further_shuffle(stored):
    text = plan(artists.artist_overview(stored))
    assert text.count("Exchange hashpartitioning") == 3  # stats, stats by name, top tracks


def test_hot_keys_give_the_same_results(spark, stored):
    """A third of all rows share one track id, and another third one artist."""
    base = stored.select(*S.RAW_TRACKS.fieldNames())
    copies = base.withColumn("track_id", F.lit("hot"))
    crowd = base.withColumns(
        {"track_id": F.concat(F.lit("c"), "track_id"), "artist_name": F.lit("Crowd")}
    )
    everything = base.unionByName(copies).unionByName(crowd)
    rows = everything.collect()

    kept = cleaning.dedupe(everything)
    assert kept.count() == len({r["track_id"] for r in rows})
    audit = cleaning.cleaning_audit(everything).first()
    assert audit["duplicates_removed"] == len(rows) - kept.count()

    top = artists.top_tracks_per_artist(everything).filter("artist_name = 'Crowd'")
    own = sorted((-r["popularity"], r["track_id"]) for r in rows if r["artist_name"] == "Crowd")[:5]
    assert [r["track_id"] for r in top.orderBy("rank").collect()] == [t for _, t in own]


@pytest.mark.parametrize("hot", ["hot", None])
def test_salted_join_spreads_a_hot_key(large_tables, hot):
    spark = large_tables
    rows = [(hot if i % 3 else f"k{i % 50}", i) for i in range(3000)]
    left = spark.createDataFrame(rows, "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("unused", 3)], "k string, v int")
    joined = salted_left_join(left, right, "k", spread=["i"], target_rows=100)
    expected = left.join(right, "k", "left")
    assert sorted(map(str, joined.select("k", "i", "v").collect())) == sorted(
        map(str, expected.select("k", "i", "v").collect())
    )
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 3000 / 3
    finally:
        spark.conf.set(key, "true")


def test_copies_of_a_track_are_ranked_where_the_last_join_left_them(large_tables):
    text = plan(samples.tracks_cleaned(large_tables, FOLDER))
    assert text.count("Exchange hashpartitioning") == 6  # two a join
    assert text.count("Exchange hashpartitioning(l_") == 2  # lines by part and by order


def test_csv_files_are_as_many_as_the_tasks_that_hold_the_rows(spark):
    raw = samples.tracks_raw(spark, FOLDER).repartition(12)
    assert len(registry.csv_roundtrip(raw).inputFiles()) == 12
