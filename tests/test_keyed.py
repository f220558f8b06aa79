"""Bucketed tables: appends, upserts, failed and repeated batches, two writers at once."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trackmart.sinks import keyed

SCHEMA = "track_id string, n int, year int"


def table(spark, root, buckets=8):
    keyed.create(spark, root, SCHEMA, "track_id", buckets)
    return root


def rows(spark, ids, n=0):
    return spark.createDataFrame([(i, n, 2000 + len(i or "")) for i in ids], SCHEMA)


def content(spark, root):
    return sorted((r.track_id, r.n) for r in keyed.read(spark, root).collect())


def test_append_adds_only_absent_keys(spark, tmp_path):
    root = table(spark, str(tmp_path / "t"))
    assert content(spark, root) == []
    assert keyed.append_absent(rows(spark, ["a", "b", "a", None]), root, "one")
    assert keyed.append_absent(rows(spark, ["b", "c"], 1), root, "two")
    assert content(spark, root) == [("a", 0), ("b", 0), ("c", 1)]
    assert keyed.append_absent(rows(spark, []), root, "none")
    assert content(spark, root) == [("a", 0), ("b", 0), ("c", 1)]


def test_a_batch_is_committed_once(spark, tmp_path):
    root = table(spark, str(tmp_path / "t"))
    assert keyed.append_absent(rows(spark, ["a"]), root, "one")
    assert not keyed.append_absent(rows(spark, ["a", "b"], 1), root, "one")
    assert content(spark, root) == [("a", 0)]


def test_a_failed_append_leaves_nothing(spark, tmp_path, monkeypatch):
    root = table(spark, str(tmp_path / "t"))
    keyed.append_absent(rows(spark, ["a"]), root, "one")
    with monkeypatch.context() as broken:
        broken.setattr(keyed, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            keyed.append_absent(rows(spark, ["b"]), root, "two")
    assert content(spark, root) == [("a", 0)]
    assert keyed.append_absent(rows(spark, ["b"]), root, "two")
    assert content(spark, root) == [("a", 0), ("b", 0)]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """The second writer commits while the first one writes: the first starts over."""
    root = table(spark, str(tmp_path / "t"))
    before, met = keyed.commit, []

    def late(session, at, new):
        if not met:
            met.append(True)
            assert keyed.append_absent(rows(spark, ["a", "b"], 2), root, "second")
        return before(session, at, new)

    monkeypatch.setattr(keyed, "commit", late)
    assert keyed.append_absent(rows(spark, ["a", "c"], 1), root, "first")
    assert content(spark, root) == [("a", 2), ("b", 2), ("c", 1)]
    monkeypatch.setattr(keyed, "commit", lambda *_: False)
    with pytest.raises(keyed.Conflict):
        keyed.append_absent(rows(spark, ["d"]), root, "third")


def test_a_reader_sees_one_commit(spark, tmp_path):
    root = table(spark, str(tmp_path / "t"))
    keyed.append_absent(rows(spark, ["a"]), root, "one")
    before = keyed.read(spark, root)
    keyed.upsert(rows(spark, ["a"], 5), root, "two", lambda stored, new: new)
    assert [r.n for r in before.collect()] == [0]  # its files are still there
    assert content(spark, root) == [("a", 5)]


def test_an_upsert_writes_only_touched_buckets(spark, tmp_path):
    root = table(spark, str(tmp_path / "t"), buckets=32)
    ids = [f"k{n}" for n in range(2000)]
    keyed.append_absent(rows(spark, ids), root, "all")
    before = keyed.state(spark, root).folders

    def merge(stored, new):
        return stored.join(new, "track_id", "left_anti").unionByName(new)

    keyed.upsert(rows(spark, ["k7", "new"], 9), root, "few", merge)
    after = keyed.state(spark, root).folders
    changed = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(changed) <= 2
    size = lambda folders: sum(
        f.stat().st_size for name in folders for f in (Path(root) / "data" / name).glob("*.parquet")
    )
    written = size([name for b in changed for name in after[b]])
    assert written < size([name for own in before.values() for name in own]) / 8
    want = sorted([(i, 9 if i == "k7" else 0) for i in ids] + [("new", 9)])
    assert content(spark, root) == want


def test_an_append_reads_only_touched_buckets(spark, tmp_path):
    root = table(spark, str(tmp_path / "t"), buckets=32)
    keyed.append_absent(rows(spark, [f"k{n}" for n in range(500)]), root, "all")
    now = keyed.state(spark, root)
    touched = [r[0] for r in rows(spark, ["k7"]).select(keyed.bucket_of(now)).collect()]
    files = keyed.read(spark, root, touched).inputFiles()
    assert 0 < len(files) < len(keyed.read(spark, root).inputFiles()) / 8


def test_many_appends_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_FOLDERS", 3)
    root = table(spark, str(tmp_path / "t"), buckets=1)
    for n in range(8):
        keyed.append_absent(rows(spark, [f"k{n}", "k0"], n), root, f"batch-{n}")
    assert content(spark, root) == [(f"k{n}", n) for n in range(8)]
    assert len(keyed.state(spark, root).folders[0]) <= 3
    assert keyed.read(spark, root).where(F.col("year").isNull()).isEmpty()
