from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.frames import raw, varied
from trackmart import schemas as S
from trackmart.operators import cleaning, quality
from trackmart.session import materialize, scratch_path, staged
from trackmart.sinks import tables
from trackmart.sources.fingerprint import last_recorded, record, table_fingerprint
from trackmart.sources.snapshots import current_version, read_table
from trackmart.sources.tracks import read_tracks_csv

HEADER = ",artist_name,track_name,track_id,popularity,year,genre,danceability,tempo,mode,duration_ms\n"


def csv(tmp_path, body, header=HEADER):
    path = tmp_path / "raw.csv"
    path.write_text(header + body)
    return str(path)


def test_csv_binds_by_name_and_types(spark, tmp_path):
    body = (
        '0,Act,"say ""hi"", you",a,45.0,2001,pop,0.5,120.5,1,31000\n'
        '1,"Two\nLines",None,b,x,2002,rock,nan,,0,32000\n'
        "2,,NULL,c,,2003,jazz,1,90,0,33000\n"
    )
    df = read_tracks_csv(spark, csv(tmp_path, body), multiline=True)
    assert "key" not in df.columns and "mode" not in df.columns and "_c0" not in df.columns
    kinds = {f.name: f.dataType for f in S.RAW_TRACKS.fields}
    assert all(f.dataType == kinds[f.name] for f in df.schema.fields)
    a, b, c = df.orderBy("track_id").collect()
    assert a["track_name"] == 'say "hi", you' and a["popularity"] == 45 and a["tempo"] == 120.5
    assert b["artist_name"] == "Two\nLines" and b["track_name"] == "None"
    assert b["popularity"] is None and b["danceability"] is None and b["tempo"] is None
    assert c["artist_name"] is None and c["track_name"] == "NULL" and c["popularity"] is None


def test_csv_null_tokens(spark, tmp_path):
    path = csv(tmp_path, "0,Act,None,a,1,2001,pop,0.5,1,1,1\n1,Act,nan,b,1,2001,pop,0.5,1,1,1\n")
    df = read_tracks_csv(spark, path, null_tokens=S.PANDAS_NULL_TOKENS)
    assert df.filter("track_name IS NOT NULL").count() == 0


def test_csv_named_index_column(spark, tmp_path):
    path = csv(tmp_path, "7,a,Song\n", header="Unnamed: 0,track_id,track_name\n")
    assert read_tracks_csv(spark, path).columns == ["track_id", "track_name"]


def test_csv_files_with_different_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("track_id,track_name\na,Song\n")
    (tmp_path / "b.csv").write_text("track_name,track_id\nSong,b\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        read_tracks_csv(spark, str(tmp_path)).collect()


def test_csv_headers_that_differ_beside_a_blank_field_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",track_id,danceability,energy\n0,a,0.1,0.9\n")
    (tmp_path / "b.csv").write_text(",track_id,energy,danceability\n0,b,0.9,0.1\n")
    with pytest.raises(ValueError, match="different headers"):
        read_tracks_csv(spark, str(tmp_path))


def test_csv_rows_of_the_wrong_width_are_kept_apart(spark, tmp_path):
    body = "0,a,Song\n1,b,Song,more\n2,c\n3,d,Song\n"
    path = csv(tmp_path, body, header=",track_id,track_name\n")
    rows = read_tracks_csv(spark, path, keep_malformed=True).orderBy("track_id").collect()
    assert [r["track_id"] for r in rows] == ["a", "b", "c", "d"]
    assert [r["_malformed"] for r in rows] == [None, "1,b,Song,more", "2,c", None]


def test_csv_of_several_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"track_id,year,other\nt{i},200{i},x\n")
    rows = read_tracks_csv(spark, str(tmp_path), multiline=False).collect()
    assert sorted(map(tuple, rows)) == [("t0", 2000), ("t1", 2001), ("t2", 2002)]


def test_fingerprint_ignores_layout_but_not_content(spark):
    df = varied(spark, 60)
    first = table_fingerprint(df).first()
    assert table_fingerprint(df.repartition(7).orderBy(F.desc("year"))).first() == first
    doubled = table_fingerprint(df.union(df)).first()
    assert doubled["row_count"] == 2 * first["row_count"]
    parts = lambda row: [int(p) for p in row["checksum"].split("-")]
    assert parts(doubled) == [2 * p for p in parts(first)]
    assert table_fingerprint(df.withColumn("key", F.lit(None).cast("int"))).first() != first


def test_fingerprint_manifest(spark, tmp_path):
    manifest = str(tmp_path / "manifest")
    assert last_recorded(spark, manifest) is None
    record(spark, manifest, (2, "11"), datetime(2024, 1, 1))
    record(spark, manifest, (3, "7"), datetime(2024, 1, 2))
    assert last_recorded(spark, manifest) == (3, "7")


def test_partitioned_write_and_pruning(spark, tmp_path):
    path = str(tmp_path / "tracks")
    cleaned = cleaning.clean(varied(spark))
    tables.write_partitioned(cleaned, path)
    back = spark.read.parquet(path)
    assert back.columns[-1] == "year" and dict(back.dtypes)["year"] == "int"
    assert sorted(back.select(cleaned.columns).collect()) == sorted(cleaned.collect())
    plan = back.filter("year = 2005")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_a_large_year_is_split_over_tasks(spark, tmp_path):
    path = tmp_path / "skewed"
    rows = spark.range(0, 60_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 3 != 0, 2005).otherwise(2000 + F.col("id") % 24).cast("int").alias("year"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "900KB")
    try:
        tables.write_partitioned(rows, str(path))
    finally:
        spark.conf.set(size, before)
    assert len(list((path / "year=2005").glob("*.parquet"))) > 3
    files = [len(list(folder.glob("*.parquet"))) for folder in path.glob("year=*")]
    assert len(files) == 9 and min(files) == 1
    assert spark.read.parquet(str(path)).count() == 60_000


def test_publish_replaces_and_can_read_itself(spark, tmp_path):
    root = str(tmp_path / "mart")
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_table(spark, root)
    tables.publish(spark.range(3), root, "v1", datetime(2024, 1, 1))
    tables.publish(read_table(spark, root).filter("id > 0"), root, "v2", datetime(2024, 1, 2))
    assert sorted(r["id"] for r in read_table(spark, root).collect()) == [1, 2]
    tables.publish(spark.range(5), root, "v2", datetime(2024, 1, 2))  # a re-run
    assert read_table(spark, root).count() == 5


def test_staged_snapshot_is_not_current(spark, tmp_path):
    root = str(tmp_path / "mart")
    tables.publish(spark.range(3), root, "v1", datetime(2024, 1, 1))
    tables.stage(spark.range(9), root, "v2")
    assert read_table(spark, root).count() == 3


def test_insert_if_absent_is_idempotent(spark):
    old = raw(spark, {"track_id": "a", "year": 2001}, {"track_id": "b"})
    new = raw(
        spark,
        {"track_id": "a", "year": 2002},
        {"track_id": "c", "year": 2004},
        {"track_id": "c", "year": 2003},
    )
    once = tables.insert_if_absent(new, old, tie_breakers=["year"])
    assert {r["track_id"]: r["year"] for r in once.collect()} == {"a": 2001, "b": 2010, "c": 2003}
    assert tables.insert_if_absent(new, once, tie_breakers=["year"]).count() == 3


def test_append_absent_to_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "tracks")
    tables.write_partitioned(raw(spark, {"track_id": "a"}), path)
    new = raw(spark, {"track_id": "a", "year": 2020}, {"track_id": "b"}, {"track_id": "b"})
    tables.append_absent(new, path)
    tables.append_absent(new, path)
    stored = spark.read.parquet(path)
    assert sorted((r["track_id"], r["year"]) for r in stored.collect()) == [("a", 2010), ("b", 2010)]


def test_validation_document(spark, tmp_path):
    checks = quality.validate_raw(raw(spark, {"tempo": 0.0}), min_rows=1)
    path = str(tmp_path / "report")
    tables.write_report(tables.validation_document(checks, datetime(2024, 1, 1)), path)
    report = spark.read.json(path).first()
    assert (report["total"], report["passed"], report["failed"]) == (18, 17, 1)
    assert report["pass_rate"] == "94.4%"
    assert report["checks"][0]["check"] == "required_columns_present"
    assert [c["check"] for c in report["checks"] if not c["passed"]] == ["tempo_positive"]


def test_scratch_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base)
    assert materialize(spark.range(4), "four").count() == 4


def test_staged_tables_go_away(spark):
    with staged(spark.range(4), "four") as four:
        (file,) = {f.rsplit("/", 1)[0] for f in four.inputFiles()}
        assert four.count() == 4
    with pytest.raises(AnalysisException):
        spark.read.parquet(file)
