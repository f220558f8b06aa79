"""Model inputs: engineered features, codes, defaults and domain checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import complete

# Engineered features as SQL, so that the same text serves a DataFrame and the
# transformer stage inside the model pipeline.
FEATURE_SQL = {
    "decade": "CAST(floor(year / 10) * 10 AS DOUBLE)",
    "tempo_energy": "tempo * energy",
    "dance_valence": "danceability * valence",
    "acoustic_energy": "acousticness * (1 - energy)",
    "loudness_energy": "(loudness + 60) * energy",
    "speech_instrument": "speechiness + instrumentalness",
    "duration_min": "duration_ms / 60000",
    "log_duration": "log1p(duration_ms)",
}

_CODE_CASES = " ".join(f"WHEN '{group}' THEN {code}" for group, code in S.GENRE_CODES.items())
GENRE_CODE_SQL = f"CASE genre_group {_CODE_CASES} ELSE {S.GENRE_CODE_UNKNOWN} END"


def training_rows(tracks: DataFrame) -> DataFrame:
    """Rows complete in all training columns."""
    return tracks.filter(complete(tracks, S.TRAINING_COLUMNS))


def engineered_features(tracks: DataFrame) -> DataFrame:
    return tracks.withColumns({name: F.expr(sql) for name, sql in FEATURE_SQL.items()})


def add_genre_code(tracks: DataFrame) -> DataFrame:
    """Fixed integer code of the genre group; unknown and null map to the last."""
    return tracks.withColumn("genre_idx", F.expr(GENRE_CODE_SQL))


def score_defaults(requests: DataFrame) -> DataFrame:
    """Fill missing scoring inputs with their documented defaults.

    An input the request table lacks altogether is added, as the default throughout.
    """
    absent = {c: F.lit(v) for c, v in S.SCORE_DEFAULTS.items() if c not in requests.columns}
    return requests.withColumns(absent).na.fill(S.SCORE_DEFAULTS)


def input_domain_check(requests: DataFrame) -> DataFrame:
    """Add ``violations``: inputs outside their allowed range. Null is a violation."""
    flags = [
        F.when(~F.coalesce(F.col(c).between(low, high), F.lit(False)), F.lit(c))
        for c, (low, high) in S.INPUT_RANGES.items()
    ]
    return requests.withColumn("violations", F.array_compact(F.array(*flags)))
