"""The three lifecycles end to end, and the command line over them."""

import json
from datetime import datetime

import pytest

from tests.frames import raw, varied
from trackmart import jobs
from trackmart import schemas as S
from trackmart.operators import cleaning, quality
from trackmart.plans.publishing import clean_and_publish, read_mart
from trackmart.sources.snapshots import current_version, read_table

NOW = datetime(2024, 1, 1)


def test_publish(spark, tmp_path):
    root = str(tmp_path)
    source = varied(spark).unionByName(raw(spark, {"track_id": "t1", "tempo": 0.0}))
    done = clean_and_publish(source, root, "v1", NOW, min_rows=10)
    assert "track_id_unique" in done.failed_raw_checks
    tracks = read_table(spark, f"{root}/tracks")
    expected = cleaning.clean(source)
    assert sorted(tracks.select(expected.columns).collect()) == sorted(expected.collect())
    for name in ("music_trends", "genre_stats", "mood_map"):
        mart = read_table(spark, f"{root}/{name}")
        assert quality.schema_mismatches(mart, getattr(S, name.upper())) == []
        assert quality.key_violations(mart, S.PRIMARY_KEYS[name]).count() == 0
    years = [r["year"] for r in read_mart(spark, root, "music_trends").collect()]
    assert years == sorted(years) and len(years) == 24
    scores = [r["avg_popularity"] for r in read_mart(spark, root, "genre_stats").collect()]
    assert scores == sorted(scores, reverse=True)
    served = cleaning.serving_projection(tracks)
    assert quality.schema_mismatches(served, S.TRACKS) == []
    assert spark.read.json(f"{root}/reports/cleaned").first()["pass_rate"] == "100.0%"
    audit = spark.read.json(f"{root}/reports/cleaning_audit").first()
    assert audit["clean_rows"] == tracks.count()


def test_failed_gate_keeps_the_old_tables_and_leaves_a_report(spark, tmp_path):
    root = str(tmp_path)
    clean_and_publish(varied(spark), root, "v1", NOW, min_rows=10)
    with pytest.raises(quality.ValidationError, match="year_range_2000_2023"):
        clean_and_publish(raw(spark, {"year": 1990}), root, "v2", datetime(2024, 1, 2), min_rows=1)
    assert current_version(spark, f"{root}/tracks") == "v1"
    assert current_version(spark, f"{root}/music_trends") == "v1"
    assert spark.read.json(f"{root}/reports/cleaned").first()["failed"] == 1


def test_missing_columns_stop_the_run_with_a_report(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(quality.ValidationError, match="required_columns_present"):
        clean_and_publish(raw(spark, {}).drop("tempo"), root, "v1", NOW, min_rows=1)
    assert spark.read.json(f"{root}/reports/raw").first()["failed"] == 2
    assert current_version(spark, f"{root}/tracks") is None


def test_jobs(spark, tmp_path, capsys):
    root, source = str(tmp_path / "store"), str(tmp_path / "csv")
    varied(spark).write.option("header", True).option("escape", '"').csv(source)
    publish = ["publish", "--root", root, "--raw", source, "--min-rows", "10", "--skip-unchanged"]
    with pytest.raises(quality.ValidationError):
        jobs.main([*publish[:-3], "--min-rows", "1000000", "--skip-unchanged"])
    jobs.main(publish)  # the failed run did not mark the input as done
    first = current_version(spark, f"{root}/tracks")
    jobs.main(publish)
    assert "unchanged" in capsys.readouterr().out
    assert current_version(spark, f"{root}/tracks") == first

    jobs.main(["prompts", "--root", root, "--out", f"{root}/prompts"])
    prompts = spark.read.parquet(f"{root}/prompts")
    assert prompts.count() == 23
    reply = json.dumps({"origin_country": "Peru"})
    replies = [(r["artist_name"], reply, NOW) for r in prompts.collect()][:20]
    replies += [("Act 0", "no idea", NOW)]
    spark.createDataFrame(
        replies, "artist_name string, reply string, generated_at timestamp"
    ).write.parquet(f"{root}/replies")
    jobs.main(["merge", "--root", root, "--replies", f"{root}/replies"])
    stored = read_table(spark, f"{root}/artist_profiles")
    assert quality.schema_mismatches(stored, S.ARTIST_PROFILES) == []
    assert stored.count() == 20
    jobs.main(["prompts", "--root", root, "--out", f"{root}/prompts2"])
    assert spark.read.parquet(f"{root}/prompts2").count() == 3


def test_score_job(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    clean_and_publish(varied(spark), root, "v1", NOW, min_rows=10)
    monkeypatch.setitem(jobs.training.model.COMPACT_FOREST, "maxDepth", 3)
    jobs.main(["train", "--root", root, "--kind", "compact"])
    tracks = read_table(spark, f"{root}/tracks")
    tracks.select("track_id", *S.SCORE_DEFAULTS).write.parquet(f"{root}/requests")
    jobs.main(["score", "--root", root, "--kind", "compact", "--requests", f"{root}/requests",
               "--out", f"{root}/scored"])
    assert spark.read.parquet(f"{root}/scored").count() == tracks.count()


def test_incremental_jobs(spark, tmp_path, capsys):
    root = str(tmp_path)
    clean_and_publish(varied(spark), root, "v1", NOW, min_rows=10)
    before = {n: sorted(map(str, read_mart(spark, root, n).collect())) for n in ("mood_map", "artist_stats")}
    jobs.main(["refresh", "--root", root])
    assert current_version(spark, f"{root}/mood_map") != "v1"
    jobs.main(["refresh", "--root", root])
    assert "refreshed years: []" in capsys.readouterr().out
    assert sorted(map(str, read_mart(spark, root, "artist_stats").collect())) == before["artist_stats"]
    assert read_mart(spark, root, "mood_map").count() == len(before["mood_map"])

    tracks = read_table(spark, f"{root}/tracks")
    tracks.write.parquet(f"{root}/incoming")
    for _ in range(2):
        jobs.main(["append", "--root", root, "--tracks", f"{root}/incoming", "--batch", "b1", "--buckets", "4"])
    assert "was appended before" in capsys.readouterr().out
    assert jobs.keyed.read(spark, f"{root}/track_details_by_id").count() == tracks.count()

    jobs.main(["index-names", "--root", root])
    for flag in ([], ["--indexed"]):
        jobs.main(["search", "--root", root, "--term", "act 1", "--out", f"{root}/found{len(flag)}", *flag])
    found = [spark.read.parquet(f"{root}/found{n}").collect() for n in (0, 1)]
    assert sorted(found[0]) == sorted(found[1]) and len(found[0]) == 10

    reply = json.dumps({"origin_country": "Peru"})
    rows = [("Act 1", reply, NOW), ("Act 2", reply, NOW), ("Act 3", "no idea", NOW)]
    spark.createDataFrame(rows, "artist_name string, reply string, generated_at timestamp").write.parquet(f"{root}/replies")
    for _ in range(2):
        jobs.main(["merge", "--root", root, "--replies", f"{root}/replies", "--batch", "one"])
    stored = jobs.keyed.read(spark, f"{root}/artist_profiles_by_name")
    assert quality.schema_mismatches(stored, S.ARTIST_PROFILES) == [] and stored.count() == 2
    assert spark.read.parquet(f"{root}/rejected_replies/one").count() == 1
    jobs.main(["prompts", "--root", root, "--out", f"{root}/prompts"])
    assert spark.read.parquet(f"{root}/prompts").count() == 21
