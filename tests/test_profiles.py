import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_artists import profile_rows, tracks
from trackmart.operators import artists, profiles
from trackmart.plans import insight

FULL = {
    "origin_country": "France",
    "career_start": 1999,
    "style_description": "soft",
    "fun_fact": "none",
    "audio_analysis": "quiet",
    "career_insight": "steady",
    "similar_artists": ["A", "B"],
    "signature_sound": "hum",
}
BODY = json.dumps(FULL)


@pytest.mark.parametrize(
    "reply, body",
    [
        ("```json\n{1}\n```", "{1}"),
        ("```\n{1}\n```", "{1}"),
        ("  {1}\n", "{1}"),
        ("See:\n```json{1}```\nand ```more```", "{1}"),
        ("```first``` then ```json\n{2}```", "{2}"),
        ("```json\n{1}", "{1}"),
        ("```\n{1}", "{1}"),
        ("```JSON\n{1}```", "JSON\n{1}"),
        ("", ""),
    ],
)
def test_reply_body(spark, reply, body):
    df = spark.createDataFrame([(reply,)], "reply string")
    assert df.select(profiles.reply_body(F.col("reply"))).first()[0] == body


def parse(spark, *replies):
    rows = [("ACT", r, datetime(2024, 1, 1)) for r in replies]
    df = spark.createDataFrame(rows, "artist_name string, reply string, generated_at timestamp")
    known = artists.primary_genre(artists.artist_stats(tracks(spark, {"year": 2007})))
    return profiles.parse_replies(df, known)


def test_full_reply(spark):
    row = profiles.accepted(parse(spark, f"```json\n{BODY}\n```")).first().asDict()
    assert row["artist_name"] == "Act"
    assert json.loads(row.pop("similar_artists")) == FULL["similar_artists"]
    assert {k: row[k] for k in FULL if k in row} == {
        k: v for k, v in FULL.items() if k != "similar_artists"
    }


def test_defaults_are_for_missing_keys_only(spark):
    row = profiles.accepted(parse(spark, '{"fun_fact": null, "career_start": null}')).first()
    assert row["fun_fact"] is None and row["career_start"] is None
    row = profiles.accepted(parse(spark, "{}")).first()
    assert row["origin_country"] == "Unknown" and row["style_description"] == ""
    assert row["career_start"] == 2007 and row["similar_artists"] == "[]"


UNUSABLE = [
    '{"a": ',
    "[1, 2]",
    '"text"',
    "sorry",
    "",
    "7",
    "null",
    '{"fun_fact": "x"} and more',
    '{"fun_fact": "x"}] and more',
    '{"fun_fact": "x"}, {"fun_fact": "y"}',
    '{"fun_fact": "x"}{"fun_fact": "y"}',
    '{"fun_fact": "x",}',
    "{'fun_fact': 'x'}",
    '{"career_start": "about 1999"}',
]


@pytest.mark.parametrize("reply", UNUSABLE)
def test_unusable_replies_are_kept_apart(spark, reply):
    parsed = parse(spark, reply)
    assert profiles.accepted(parsed).count() == 0
    assert profiles.quarantine(parsed).first()["reply"] == reply


def test_reply_values_of_other_types(spark):
    reply = '{"career_start": "1998", "similar_artists": "One", "fun_fact": 7}'
    row = profiles.accepted(parse(spark, reply)).first()
    assert (row["career_start"], row["similar_artists"], row["fun_fact"]) == (1998, '"One"', "7")
    row = profiles.accepted(parse(spark, '{"career_start": 1998.5, "similar_artists": null}')).first()
    assert (row["career_start"], row["similar_artists"]) == (1999, "null")


def test_reply_for_an_unknown_artist_is_rejected_with_its_name(spark):
    df = spark.createDataFrame(
        [("Who", "{}", datetime(2024, 1, 1))], "artist_name string, reply string, generated_at timestamp"
    )
    known = artists.primary_genre(artists.artist_stats(tracks(spark, {})))
    parsed = profiles.parse_replies(df, known)
    assert profiles.accepted(parsed).count() == 0
    row = profiles.quarantine(parsed).first()
    assert (row["artist_name"], row["reason"]) == ("Who", "unknown artist")


def test_of_a_repeated_key_the_last_counts(spark):
    reply = '{"origin_country": "X", "similar_artists": ["a"], "origin_country": "Y", "similar_artists": ["b"]}'
    row = profiles.accepted(parse(spark, reply)).first()
    assert (row["origin_country"], row["similar_artists"]) == ("Y", '["b"]')


def test_reasons(spark):
    reasons = {r: profiles.quarantine(parse(spark, r)).first()["reason"] for r in UNUSABLE}
    assert reasons.pop('{"career_start": "about 1999"}') == "career start is no number"
    assert set(reasons.values()) == {"not one JSON object"}


def test_upsert(spark):
    stored = profile_rows(spark, ("old", "[]", 2030), ("both", "[]", 2030))
    incoming = profile_rows(spark, ("both", '["n"]', 2020), ("both", '["m"]', 2021), ("new", "[]", 2020))
    merged = profiles.profile_upsert(stored, incoming)
    rows = {r["artist_name"]: r["similar_artists"] for r in merged.collect()}
    assert rows == {"old": "[]", "both": '["m"]', "new": "[]"}
    again = profiles.profile_upsert(merged, incoming)
    assert sorted(again.collect()) == sorted(merged.collect())


def test_prompts(spark):
    df = tracks(spark, {"track_name": "B", "popularity": 40}, {"track_name": "A", "popularity": 61})
    (row,) = profiles.profile_prompts(artists.artist_overview(df)).collect()
    lines = row["prompt"].split("\n")
    assert "- main genre: Pop" in lines and "- mean popularity: 50.5 of 100" in lines
    assert "- mean tempo: 120.0 beats a minute" in lines
    assert "- years with tracks: 2010 to 2010" in lines
    assert "Most popular titles: A, B" in lines
    assert [line.split(":")[0][2:] for line in lines[-8:]] == profiles.REPLY_KEYS


def test_pending_prompts_skip_stored_artists(spark):
    df = tracks(spark, {"artist_name": "Act"}, {"artist_name": "Solo"})
    pending = insight.pending_prompts(df, profile_rows(spark, ("ACT", "[]", 2020)))
    assert [r["artist_name"] for r in pending.collect()] == ["Solo"]


def test_merge_replies(spark):
    df = tracks(spark, {"artist_name": "Act"}, {"artist_name": "Solo"})
    replies = spark.createDataFrame(
        [("act", BODY, datetime(2024, 1, 1)), ("solo", "no", datetime(2024, 1, 1))],
        "artist_name string, reply string, generated_at timestamp",
    )
    parsed = insight.read_replies(artists.artist_stats(df), replies)
    merged = insight.merge_replies(profile_rows(spark, ("Act", "[]", 2020)), parsed)
    (row,) = merged.profiles.collect()
    assert row["artist_name"] == "Act" and row["origin_country"] == "France"
    assert [r["artist_name"] for r in merged.rejected.collect()] == ["Solo"]


def test_similar_links(spark):
    known = artists.primary_genre(artists.artist_stats(tracks(spark, {"artist_name": "Hot"})))
    stored = profile_rows(spark, *[(f"a{i}", '["HOT", "gone"]', 2020) for i in range(50)])
    links = profiles.similar_artist_links(stored, known)
    assert links.count() == 100
    assert links.filter("matched_artist = 'Hot'").count() == 50


def test_similar_roundtrip(spark):
    df = profile_rows(spark, ("a", '["x","y\\"z"]', 2020), ("b", None, 2020))
    back = profiles.encode_similar(profiles.decode_similar(df)).orderBy("artist_name").collect()
    assert [r["similar_artists"] for r in back] == ['["x","y\\"z"]', "[]"]
