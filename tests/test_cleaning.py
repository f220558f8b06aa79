import math
import random

import pytest

from tests.frames import raw
from trackmart.operators import cleaning
from trackmart.sources.tracks import nan_to_null


def ids(df):
    return sorted(r["track_id"] for r in df.collect())


@pytest.mark.parametrize("flip", [False, True])
def test_dedupe_ignores_input_order(spark, flip):
    rows = [{"track_id": "a", "track_name": None}, {"track_id": "a", "track_name": "Named"}]
    df = raw(spark, *(reversed(rows) if flip else rows))
    assert [r["track_name"] for r in cleaning.dedupe(df).collect()] == [None]


def test_dedupe_runs_before_the_null_drop(spark):
    df = raw(spark, {"track_id": "a", "track_name": None}, {"track_id": "a"}, {"track_id": "b"})
    assert ids(cleaning.clean(df)) == ["b"]


def test_dedupe_treats_null_keys_as_one(spark):
    df = raw(spark, {"track_id": None}, {"track_id": None, "year": 2001}, {"track_id": "b"})
    assert cleaning.dedupe(df).count() == 2


def test_drop_nulls_keeps_the_text_nan(spark):
    holes = [{"track_id": c, c: None} for c in ("popularity", "genre", "artist_name", "track_name")]
    df = raw(spark, *holes, {"track_id": "kept", "track_name": "nan"})
    assert ids(cleaning.drop_nulls(df)) == ["kept"]


def test_sentinel(spark):
    fixed = cleaning.fix_sentinel(raw(spark, {"key": -1}, {"key": 0}, {"key": None}))
    assert [r["key"] for r in fixed.orderBy("track_id").collect()] == [None, 0, None]
    without = raw(spark, {}).drop("key")
    assert cleaning.fix_sentinel(without).columns == without.columns


def test_outlier_limits(spark):
    nan = math.nan
    out = [
        {"duration_ms": 30_000},
        {"duration_ms": None},
        {"tempo": 0.0},
        {"tempo": None},
        {"tempo": nan},
        {"loudness": 0.0},
        {"loudness": None},
        {"loudness": nan},
        {"popularity": -1},
        {"popularity": 101},
        {"popularity": None},
    ]
    kept = [{"duration_ms": 30_001}, {"popularity": 0}, {"popularity": 100}]
    df = raw(spark, *[{"track_id": f"out{i}", **c} for i, c in enumerate(out)],
             *[{"track_id": f"kept{i}", **c} for i, c in enumerate(kept)])
    assert ids(cleaning.outlier_filter(nan_to_null(df))) == ["kept0", "kept1", "kept2"]


@pytest.mark.parametrize(
    "genre, group",
    [
        ("k-pop", "Pop"),
        ("Pop", "Other"),
        ("hip-hop", "Hip-Hop"),
        ("electro", "Other"),
        ("electronic", "Electronic"),
        ("metalcore", "Metal"),
        ("pop-rock", "Pop"),
        ("rock acoustic", "Rock"),
        ("gospel", "Gospel"),
        ("", "Other"),
        (None, "Other"),
    ],
)
def test_genre_group(spark, genre, group):
    df = cleaning.add_genre_group(raw(spark, {"genre": genre}))
    assert df.first()["genre_group"] == group


def test_tiers(spark):
    df = cleaning.add_popularity_tier(raw(spark, *[{"popularity": p} for p in (30, 31, 60, 61, None)]))
    tiers = [r["popularity_tier"] for r in df.orderBy("track_id").collect()]
    assert tiers == ["Low", "Mid", "Mid", "High", "High"]


def test_audit_equals_step_by_step_counts(spark):
    df = raw(
        spark,
        {"track_id": "a"},
        {"track_id": "a", "track_name": None},
        {"track_id": "b", "tempo": 0.0},
        {"track_id": "c", "genre": None, "tempo": 0.0},
        {"track_id": "d"},
        {"track_id": "d"},
        {"track_id": None},
    )
    deduped = cleaning.dedupe(df)
    filled = cleaning.drop_nulls(deduped)
    row = cleaning.cleaning_audit(df).first()
    assert row["raw_rows"] == df.count()
    assert row["duplicates_removed"] == df.count() - deduped.count()
    assert row["nulls_removed"] == deduped.count() - filled.count()
    assert row["clean_rows"] == cleaning.clean(df).count()
    assert row["outliers_removed"] == filled.count() - row["clean_rows"]
    assert row["removed_total"] == row["raw_rows"] - row["clean_rows"]
    assert row["retention_pct"] == pytest.approx(100 * row["clean_rows"] / row["raw_rows"], abs=0.01)


def test_audit_of_nothing(spark):
    row = cleaning.cleaning_audit(raw(spark, {}).limit(0)).first()
    assert row["raw_rows"] == row["clean_rows"] == 0 and row["retention_pct"] is None


def test_coerced_tracks(spark):
    df = cleaning.clean(raw(spark, {})).withColumn("popularity", cleaning.F.lit(44.0))
    df = df.withColumn("track_name", cleaning.F.lit(None).cast("string"))
    coerced = cleaning.coerce_tracks(df)
    assert coerced.columns == cleaning.S.TRACKS.fieldNames()
    row = coerced.first()
    assert row["popularity"] == 44 and row["track_name"] == ""
    assert dict(coerced.dtypes)["popularity"] == "int"


def test_cleaning_equals_a_plain_python_computation(spark):
    dice = random.Random(7)

    def draw(*values):
        return dice.choice(values)

    changes = [
        {
            "track_id": draw(None, *[f"t{i}" for i in range(120)]),
            "track_name": draw(None, "Song", "Song", "Tune", "Air"),
            "artist_name": draw(None, "Act", "Act", "Band", "Duo"),
            "genre": draw(None, "pop", "k-pop", "jazz", "rock"),
            "popularity": draw(None, -1, 0, 30, 31, 60, 61, 100, 101),
            "tempo": draw(None, 0.0, 90.0, 120.0, 130.0),
            "loudness": draw(-1.0, -2.0, -3.0, 0.0),
            "duration_ms": draw(30_000, 30_001, 200_000, 200_000),
            "key": draw(-1, 0, 5, None),
        }
        for _ in range(300)
    ]
    df = raw(spark, *changes)
    order = [c for c in df.columns if c != "track_id"]
    first = {}
    for row in df.collect():
        rank = [(row[c] is not None, row[c]) for c in order]
        if row["track_id"] not in first or rank < first[row["track_id"]][0]:
            first[row["track_id"]] = (rank, row)
    named = [
        r for _, r in first.values()
        if None not in (r["popularity"], r["genre"], r["artist_name"], r["track_name"])
    ]
    kept = [
        r for r in named
        if r["duration_ms"] > 30_000 and (r["tempo"] or 0) > 0 and r["loudness"] < 0
        and 0 <= r["popularity"] <= 100
    ]
    expected = sorted(
        (str(r["track_id"]), None if r["key"] == -1 else r["key"], r["popularity"]) for r in kept
    )
    got = cleaning.clean(df).select("track_id", "key", "popularity").collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == expected
    audit = cleaning.cleaning_audit(df).first()
    assert audit["duplicates_removed"] == 300 - len(first)
    assert audit["nulls_removed"] == len(first) - len(named)
    assert audit["outliers_removed"] == len(named) - len(kept)
