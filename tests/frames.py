"""Small hand-made track frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackmart import schemas as S

GOOD = {
    "track_id": "t1",
    "track_name": "Song",
    "artist_name": "Act",
    "genre": "pop",
    "popularity": 50,
    "year": 2010,
    "danceability": 0.5,
    "energy": 0.5,
    "loudness": -8.0,
    "tempo": 120.0,
    "valence": 0.5,
    "acousticness": 0.3,
    "speechiness": 0.05,
    "instrumentalness": 0.0,
    "liveness": 0.1,
    "duration_ms": 200_000,
    "key": 3,
}


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    """Valid rows, each with some columns changed; ids are numbered when not given."""
    rows = [{**GOOD, "track_id": f"t{i}", **change} for i, change in enumerate(changes)]
    names = S.RAW_TRACKS.fieldNames()
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], S.RAW_TRACKS)


def varied(spark: SparkSession, rows: int = 400) -> DataFrame:
    """A catalogue large enough to train on, in which loudness decides popularity."""
    genres = ["pop", "hard-rock", "jazz", "gospel"]
    changes = []
    for i in range(rows):
        level = (i * 37) % 100
        changes.append(
            {
                "artist_name": f"Act {i % 23}",
                "track_name": f"Song {i}",
                "genre": genres[i % 4],
                "popularity": level,
                "year": 2000 + i % 24,
                "loudness": -60.0 + level * 0.55,
                "energy": (i % 11) / 10,
                "valence": (i % 7) / 6,
                "duration_ms": 60_000 + i * 311,
            }
        )
    return raw(spark, *changes)
