"""States of the marts: merged against rebuilt, one changed year read alone."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.frames import varied
from trackmart.operators import artists, cleaning, marts, states
from trackmart.plans import refresh, registry
from trackmart.plans.refresh import read_states, refresh_states
from trackmart.session import RELEASE
from trackmart.sinks import keyed, tables
from trackmart.sources import fingerprint

BUILDS = [states.music_trends, states.genre_stats, states.mood_map, states.artist_stats]


@pytest.fixture(scope="module")
def cleaned(spark):
    return cleaning.clean(varied(spark, 600)).persist()


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_marts_from_states_equal_the_plain_ones(cleaned):
    kept = states.track_states(cleaned)
    assert rows(states.music_trends(kept, 6)) == rows(marts.music_trends(cleaned, 6))
    assert rows(states.genre_stats(kept, 6)) == rows(marts.genre_stats(cleaned, 6))
    assert rows(states.mood_map(kept, 6)) == rows(marts.mood_map(cleaned, 6))
    assert rows(states.artist_stats(kept)) == rows(artists.artist_stats(cleaned))


def test_missing_values_do_not_count(spark, cleaned):
    holes = cleaned.withColumn("energy", F.when(F.col("year") > 2005, F.col("energy")))
    nan = holes.withColumn("valence", F.when(F.col("year") == 2003, F.lit(float("nan"))).otherwise(F.col("valence")))
    got = {r.year: r for r in states.music_trends(states.track_states(nan)).collect()}
    assert got[2003].avg_energy is None and got[2003].avg_valence is None and got[2007].avg_energy is not None
    assert states.track_states(cleaned.limit(0)).count() == 0


def test_one_changed_year_is_refreshed_alone(spark, cleaned, tmp_path):
    root, stored = str(tmp_path / "states"), str(tmp_path / "tracks")
    tables.write_partitioned(cleaned, stored)
    years = sorted(r[0] for r in cleaned.select("year").distinct().collect())
    read = lambda: spark.read.parquet(stored).select(cleaned.columns)
    assert refresh_states(read(), root) == years
    assert refresh_states(read().repartition(7), root) == []  # layout does not matter
    before = keyed.state(spark, root)

    louder = cleaned.where("year = 2004").withColumn("energy", F.col("energy") / 3 + 0.1)
    louder.drop("year").write.mode("overwrite").parquet(f"{stored}/year=2004")
    assert refresh_states(read(), root) == [2004]
    after = keyed.state(spark, root)
    assert [y for y in after.folders if after.folders[y] != before.folders[y]] == [2004]
    newest = after.folders[2004][0].split("/")[0]
    assert [p.name for p in (Path(root) / "data" / newest).iterdir() if p.is_dir()] == [f"{keyed.BUCKET}=2004"]

    for build in BUILDS:  # to the last bit
        assert rows(build(read_states(spark, root))) == rows(build(states.track_states(read())))


def shuffles_on_disk(spark):
    """Ids of the shuffles that have files."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name.split("_")[1] for d in folders for p in Path(d.getPath()).glob("*/shuffle_*_*")}


def left_over(spark, before, most):
    """New shuffles on disk, once there are at most ``most`` or ten seconds have gone by."""
    until = time.monotonic() + 10
    while len(found := shuffles_on_disk(spark) - before) > most and time.monotonic() < until:
        time.sleep(0.1)
    return found


def test_states_leave_no_shuffle_files(spark, cleaned, tmp_path):
    tracks = cleaned.repartition(3).localCheckpoint()
    before = shuffles_on_disk(spark)
    refresh_states(tracks, str(tmp_path / "states"))
    assert len(left_over(spark, before, 1)) <= 1  # of the fingerprints, a row per year and task
    assert spark.conf.get(RELEASE) == "false"


def test_tracks_stored_for_states_leave_no_shuffle_files(spark, cleaned, monkeypatch):
    monkeypatch.setattr(refresh, "refresh_states", lambda *_: None)
    monkeypatch.setattr(refresh, "read_states", lambda *_: None)
    before = shuffles_on_disk(spark)
    registry._refreshed_states(cleaned.repartition(5, "track_id").repartition(3, "year"))
    assert not left_over(spark, before, 0)


def test_a_year_that_is_gone_is_dropped(spark, cleaned, tmp_path):
    root = str(tmp_path / "states")
    refresh_states(cleaned, root)
    assert refresh_states(cleaned.where("year <> 2010"), root) == [2010]
    assert read_states(spark, root).where("year = 2010").isEmpty()
    undated = cleaned.withColumn("year", F.lit(None).cast("int"))
    assert len(refresh_states(undated, root)) > 10
    assert read_states(spark, root).isEmpty()


def test_parts_that_differ(spark, cleaned):
    before = fingerprint.part_fingerprints(cleaned.where("year <> 2002"))
    changed = cleaned.where("year <> 2003").withColumn(
        "tempo", F.when(F.col("year") == 2001, F.col("tempo") + 1).otherwise(F.col("tempo"))
    )
    found = fingerprint.changed_parts(fingerprint.part_fingerprints(changed.repartition(5)), before)
    assert sorted(map(tuple, found.collect())) == [("2001", "changed"), ("2002", "added"), ("2003", "removed")]


def test_one_changed_file_is_one_changed_part(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text(f"track_id\n{n}\n")
    recorded = spark.createDataFrame(
        fingerprint.file_fingerprints(spark, str(tmp_path)).collect(), "part string, row_count long, checksum string"
    )
    (tmp_path / "1.csv").write_text("track_id\n1\n2\n")
    found = fingerprint.changed_parts(fingerprint.file_fingerprints(spark, str(tmp_path)), recorded).collect()
    assert [(Path(r.part).name, r.change) for r in found] == [("1.csv", "changed")]
