import pytest
from pyspark.sql import functions as F

from tests.frames import raw, varied
from trackmart import schemas as S
from trackmart.operators import artists, cleaning, marts


def tracks(spark, *changes):
    return cleaning.clean(raw(spark, *changes))


def profile_rows(spark, *rows):
    """(name, similar JSON, year generated) as stored profiles."""
    sql = "artist_name string, similar_artists string, y int"
    df = spark.createDataFrame(list(rows), sql)
    stamp = F.make_timestamp("y", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    texts = [c for c in S.ARTIST_PROFILES.fieldNames() if c not in ("artist_name", "similar_artists")]
    df = df.withColumns({c: F.lit(c) for c in texts})
    df = df.withColumns({"career_start": F.col("y"), "generated_at": stamp})
    return df.select(S.ARTIST_PROFILES.fieldNames())


def test_rounding_is_half_away_from_zero(spark):
    df = tracks(spark, *[{"energy": e, "loudness": l} for e, l in ((0.0005, -1.125), (0.0, -1.125))])
    row = artists.artist_stats(df).first()
    assert row["avg_energy"] == 0.0 and row["avg_loudness"] == -1.13
    df = tracks(spark, *[{"energy": e} for e in (0.001, 0.0)])
    assert artists.artist_stats(df).first()["avg_energy"] == 0.001


def test_stats_have_17_columns_and_detail_14(spark):
    stats = artists.artist_stats(tracks(spark, {}, {"genre": "rock", "popularity": 80}))
    assert len(stats.columns) == 17 and stats.count() == 2
    detail = artists.artist_detail(stats, "aCT")
    assert len(detail.columns) == 14 and detail.count() == 2
    assert artists.artist_detail(stats, "nobody").count() == 0


def test_search_wildcards_and_literals(spark):
    df = tracks(spark, *[{"artist_name": n} for n in ("100% Act", "100 Acts", "A_B", "AxB", "Other")])
    stats = artists.artist_stats(df)

    def found(term, **options):
        return sorted(r["artist_name"] for r in artists.artist_search(stats, term, **options).collect())

    assert found("ACT") == ["100 Acts", "100% Act"]
    assert found("a_b") == ["A_B", "AxB"]
    assert found("a_b", literal=True) == ["A_B"]
    assert found("100%", literal=True) == ["100% Act"]
    assert found("a\\_b") == ["A_B"]  # an escaped wildcard
    assert found("a\\c") == ["100 Acts", "100% Act"]  # an idle escape
    assert len(found("")) == 5


def test_search_orders_and_limits(spark):
    df = tracks(spark, *[{"artist_name": f"Act {i:02}", "popularity": 90 - i // 2} for i in range(30)])
    rows = artists.artist_search(artists.artist_stats(df), "act").collect()
    assert [r["artist_name"] for r in rows] == [f"Act {i:02}" for i in range(10)]


def test_top_tracks_break_ties_by_id(spark):
    df = tracks(spark, *[{"track_id": f"t{i}", "popularity": 50} for i in range(7)],
                {"track_id": "best", "artist_name": "ACT", "popularity": 99})
    rows = artists.top_tracks_per_artist(df).orderBy("rank").collect()
    assert [r["track_id"] for r in rows] == ["best", "t0", "t1", "t2", "t3"]


def test_primary_genre(spark):
    df = tracks(spark, {"genre": "rock"}, {"genre": "rock"}, {"genre": "pop"},
                {"artist_name": "Tie", "genre": "rock"}, {"artist_name": "Tie", "genre": "pop"})
    rows = artists.primary_genre(artists.artist_stats(df)).collect()
    assert {r["artist_name"]: r["genre_group"] for r in rows} == {"Act": "Rock", "Tie": "Pop"}


def test_report_joins_on_the_name_without_case(spark):
    df = tracks(spark, {"artist_name": "Act"}, {"artist_name": "Solo", "track_name": "One"})
    stored = profile_rows(spark, ("ACT", '["X","Y"]', 2020), ("act", '["Z"]', 2021))
    rows = {r["artist_name"]: r for r in artists.artist_report(df, stored).collect()}
    assert rows["Act"]["cached"] and rows["Act"]["similar_artists"] == ["Z"]
    assert rows["Act"]["career_start"] == 2021
    assert not rows["Solo"]["cached"] and rows["Solo"]["fun_fact"] is None
    assert [tuple(t) for t in rows["Solo"]["top_tracks"]] == [("One", 50, 2010)]


def test_cached_missing_and_unknown(spark):
    df = tracks(spark, {"artist_name": "Act"}, {"artist_name": "Solo"})
    stored = profile_rows(spark, ("aCt", "[]", 2020), ("ACT", "[]", 2020))
    names = df.select("artist_name")
    assert [r[0] for r in artists.profiles_cached(names, stored).collect()] == ["Act"]
    assert [r[0] for r in artists.profiles_missing(names, stored).collect()] == ["Solo"]
    asked = spark.createDataFrame([("solo",), ("Who",), ("WHO",)], "artist_name string")
    assert [tuple(r) for r in artists.artists_not_found(asked, df).collect()] == [("who", 2)]


def test_radar_and_fingerprint(spark):
    stats = artists.artist_stats(tracks(spark, {"tempo": 260.0, "energy": 0.25}))
    radar = {r["metric"]: r["value"] for r in artists.artist_radar(stats).collect()}
    assert radar == {
        "Danceability": 0.5,
        "Energy": 0.25,
        "Valence": 0.5,
        "Acousticness": 0.3,
        "Speechiness": 0.05,
    }
    bars = artists.audio_fingerprint(stats).first()
    assert bars["tempo_pct"] == 100.0 and bars["energy_pct"] == 25.0


def test_marts_against_a_plain_computation(spark):
    df = cleaning.clean(varied(spark))
    rows = df.collect()
    for trend in marts.music_trends(df).collect():
        own = [r for r in rows if r["year"] == trend["year"]]
        assert trend["track_count"] == len(own)
        assert trend["avg_energy"] == pytest.approx(sum(r["energy"] for r in own) / len(own))
    years = [r["year"] for r in marts.music_trends(df).collect()]
    assert years == sorted(years)
    populars = [r["avg_popularity"] for r in marts.genre_stats(df).collect()]
    assert populars == sorted(populars, reverse=True)
    assert marts.top_genre(marts.genre_stats(df)).first()["avg_popularity"] == max(populars)
    kpis = marts.trend_kpis(marts.music_trends(df)).first()
    assert kpis["years_covered"] == len(years) and kpis["total_tracks"] == len(rows)
    assert sum(r["pct"] for r in marts.label_distribution(df).collect()) == pytest.approx(100, abs=0.01)
    assert sum(r["track_count"] for r in marts.genre_distribution(df).collect()) == len(rows)
    assert marts.genre_radar(marts.genre_stats(df)).count() == 4 * len(populars)
