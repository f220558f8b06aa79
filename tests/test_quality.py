import pytest

from tests.frames import raw
from trackmart import schemas as S
from trackmart.operators import cleaning, quality


def verdicts(checks):
    return {r["check"]: r["passed"] for r in checks.collect()}


def test_raw_suite_passes_on_good_rows(spark):
    result = verdicts(quality.validate_raw(raw(spark, {}, {}), min_rows=2))
    assert len(result) == 18 and all(result.values())


def test_raw_suite_default_floor_is_a_million(spark):
    result = verdicts(quality.validate_raw(raw(spark, {})))
    assert [c for c, ok in result.items() if not ok] == ["row_count_above_1m"]


@pytest.mark.parametrize(
    "change, check",
    [
        ({"track_id": None}, "track_id_not_null"),
        ({"artist_name": None}, "artist_name_not_null"),
        ({"popularity": None}, "popularity_range_0_100"),
        ({"popularity": 101}, "popularity_range_0_100"),
        ({"year": 1999}, "year_range_2000_2023"),
        ({"liveness": 1.01}, "liveness_range_0_1"),
        ({"valence": None}, "valence_range_0_1"),
        ({"tempo": 0.0}, "tempo_positive"),
        ({"loudness": 0.0}, "loudness_negative"),
        ({"duration_ms": 30_000}, "duration_ms_above_30s"),
    ],
)
def test_raw_suite_names_the_failure(spark, change, check):
    result = verdicts(quality.validate_raw(raw(spark, {}, change), min_rows=1))
    assert [c for c, ok in result.items() if not ok] == [check]


def test_raw_suite_repeated_ids(spark):
    df = raw(spark, {"track_id": "a"}, {"track_id": "a"})
    assert not verdicts(quality.validate_raw(df, 1))["track_id_unique"]


def test_raw_suite_with_a_known_number_of_duplicates(spark):
    checks = quality.validate_raw(raw(spark, {}), 1, duplicates=3)
    assert len(verdicts(checks)) == 18 and not verdicts(checks)["track_id_unique"]
    assert "hashpartitioning" not in checks._jdf.queryExecution().executedPlan().toString()


def test_raw_suite_missing_column(spark):
    result = verdicts(quality.validate_raw(raw(spark, {}).drop("tempo", "track_id"), 1))
    failed = {c for c, ok in result.items() if not ok}
    assert len(result) == 18
    assert failed == {
        "required_columns_present",
        "tempo_positive",
        "track_id_not_null",
        "track_id_unique",
    }


def test_cleaned_suite(spark):
    good = cleaning.clean(raw(spark, {}, {}))
    result = verdicts(quality.validate_cleaned(good, 2))
    assert len(result) == 16 and all(result.values())


def test_cleaned_suite_ranges_ignore_nulls(spark):
    df = cleaning.add_popularity_tier(cleaning.add_genre_group(raw(spark, {}, {"energy": None})))
    assert verdicts(quality.validate_cleaned(df, 1))["energy_range_0_1"]


def test_cleaned_suite_on_an_empty_table_fails_without_raising(spark):
    result = verdicts(quality.validate_cleaned(cleaning.clean(raw(spark, {}).limit(0)), 1))
    assert not result["popularity_range_0_100"] and not result["tempo_positive"]
    assert result["track_id_not_null"] and result["no_duplicate_track_ids"]
    assert not result["row_count_above_1"]


def test_summary_rounds_half_to_even(spark):
    rows = [("s", i, f"c{i}", i < 13) for i in range(16)]
    checks = spark.createDataFrame(rows, "stage string, position int, check string, passed boolean")
    assert tuple(quality.validation_summary(checks).first()) == ("s", 16, 13, 3, "81.2%")


def test_gate(spark):
    checks = quality.validate_raw(raw(spark, {"tempo": 0.0}), min_rows=1)
    assert quality.enforce(checks, strict=False) == ["tempo_positive"]
    with pytest.raises(quality.ValidationError, match="tempo_positive"):
        quality.enforce(checks)


def test_profile(spark):
    df = raw(spark, {"track_id": None}, {"track_id": None}, {"track_id": "b", "tempo": None}).select(
        "track_id", "track_name", "tempo"
    )
    rows = {r["column_name"]: r for r in quality.column_profile(df, "track_id").collect()}
    assert rows["tempo"]["null_count"] == 1 and rows["tempo"]["max_value"] == 120.0
    assert rows["track_name"]["min_value"] is None
    assert rows["track_id"]["duplicate_count"] == 1 and rows["track_id"]["null_count"] == 2


def test_key_and_length_violations(spark):
    df = raw(spark, {"track_id": "a"}, {"track_id": "a"}, {"track_id": None}, {"track_id": "b" * 101})
    bad = {r["track_id"]: r["row_count"] for r in quality.key_violations(df, "track_id").collect()}
    assert bad == {"a": 2, None: 1}
    rows = {r["column_name"]: r for r in quality.length_violations(df, {"track_id": 100}).collect()}
    assert rows["track_id"]["violations"] == 1 and rows["track_id"]["longest"] == 101


def test_schema_mismatches(spark):
    tracks = cleaning.serving_projection(cleaning.clean(raw(spark, {})))
    assert quality.schema_mismatches(tracks, S.TRACKS) == []
    wrong = tracks.drop("genre").withColumn("year", cleaning.F.lit("2001"))
    assert quality.schema_mismatches(wrong, S.TRACKS) == [
        "missing column genre",
        "column year is string, expected int",
    ]
