"""Search through trigram postings: the same rows as the scan, from fewer files."""

import pytest
from pyspark.sql import functions as F

from trackmart.operators import artists, search

NAMES = [
    "Anna", "anna B", "Hanna's Band", "AC/DC", "100% Pure", "Under_score", "x", "", "Ünïcode Ärtist", "A n n a",
    "back\\slash", "The The", "the", "Théâtre", "aaaa", "aaa", None, "日本語の歌手", "ab%cd", "Band of Annas",
]
TERMS = [
    "anna", "ANN", "nn", "", "a", "the", "the the", "100%", "%pure", "a%b", "under_score", "under\\_score", "_nna",
    "ac/dc", "\\", "back\\\\slash", "é", "théâ", "aaa", "aaaa", "aaaaa", "日本語", "語の歌", "ann%band", "b\\%c", "zzz", "%", "___",
    "ab\\", "s b",
]


@pytest.fixture(scope="module")
def stats(spark):
    rows = [(n, g, float((i * 7 + len(g)) % 50)) for i, n in enumerate(NAMES) for g in ("Pop", "Rock")]
    rows += [(f"artist number {n}", "Pop", float(n % 40)) for n in range(500)]
    return spark.createDataFrame(rows, "artist_name string, genre_group string, avg_popularity double").persist()


@pytest.fixture(scope="module")
def stored(spark, stats, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings") / "names")
    search.write_postings(stats, path)
    return search.read_postings(spark, path)


@pytest.mark.parametrize("literal", [False, True])
def test_search_equals_the_scan(stats, stored, literal):
    for term in TERMS:
        if not literal and term.endswith("\\") and term != "\\":
            continue  # the scan takes the backslash for an escape of its own wildcard
        want = artists.artist_search(stats, term, 1000, literal).collect()
        got = search.indexed_search(stats, stored, term, 1000, literal).collect()
        assert got == want, (term, literal)


def test_literal_runs():
    assert search.literal_runs("a%bc_d") == ["a", "bc", "d"]
    assert search.literal_runs("a\\%b") == ["a%b"] and search.literal_runs("a\\\\b") == ["a\\b"]
    assert search.literal_runs("a%b", literal=True) == ["a%b"] and search.literal_runs("%") == []
    assert search.needed_trigrams("ABCD%xy") == ["abc", "bcd"]


def test_search_reads_few_files(stats, stored):
    every = len(stored.inputFiles())
    plan = search.candidates(stored, ["num", "umb"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan and "IN" in plan.upper()
    shards = {r[0] for r in stored.where(F.col("trigram").isin("num", "umb")).select("shard").distinct().collect()}
    assert len(shards) <= 2 < every / 8


def test_postings_of_nothing(spark, stats):
    assert search.postings(stats.limit(0)).count() == 0
    assert search.postings(stats.where("artist_name = 'x'")).count() == 0
