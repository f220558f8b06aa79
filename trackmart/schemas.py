"""Table schemas and the fixed values the track model is defined by."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names, ranges, rules, labels and defaults of the model.
# --------------------------------------------------------------------------

GENRE_RULES = [
    ("pop", "Pop"),
    ("rock", "Rock"),
    ("hip-hop", "Hip-Hop"),
    ("acoustic", "Acoustic"),
    ("electronic", "Electronic"),
    ("metal", "Metal"),
    ("gospel", "Gospel"),
]
GENRE_OTHER = "Other"

TIERS = ["Low", "Mid", "High"]
TIER_LOW_MAX = 30
TIER_MID_MAX = 60
TIER_MESSAGES = {
    "High": "🔥 This could be a HIT!",
    "Mid": "🎵 Decent track — mid-tier potential.",
    "Low": "📉 Probably won't chart.",
}
TIER_FALLBACK = "Mid"

GENRE_CODES = {
    "Pop": 0,
    "Rock": 1,
    "Hip-Hop": 2,
    "Electronic": 3,
    "Acoustic": 4,
    "Metal": 5,
    "Gospel": 6,
    "Other": 7,
}
GENRE_CODE_UNKNOWN = 7

# Weights used for a class that does not occur in the data.
ABSENT_CLASS_WEIGHTS = {"High": 60.0, "Mid": 3.0}

UNIT_FEATURES = [
    "danceability",
    "energy",
    "valence",
    "acousticness",
    "speechiness",
    "instrumentalness",
    "liveness",
]
REQUIRED_COLUMNS = [
    "track_id",
    "track_name",
    "artist_name",
    "genre",
    "popularity",
    "year",
    "danceability",
    "energy",
    "loudness",
    "tempo",
    "valence",
    "acousticness",
    "speechiness",
    "instrumentalness",
    "liveness",
    "duration_ms",
]
INDEX_COLUMNS = ["_c0", "Unnamed: 0"]
NOT_NULL_COLUMNS = ["popularity", "genre", "artist_name", "track_name"]
KEY_UNKNOWN = -1
MIN_DURATION_MS = 30_000
POPULARITY_RANGE = (0, 100)
YEAR_RANGE = (2000, 2023)
MIN_ROWS = 1_000_000

TRAINING_COLUMNS = [
    "danceability",
    "energy",
    "loudness",
    "tempo",
    "valence",
    "acousticness",
    "speechiness",
    "instrumentalness",
    "liveness",
    "duration_ms",
    "year",
    "genre_group",
    "popularity_tier",
]
BASE_FEATURES = TRAINING_COLUMNS[:11]
ENGINEERED_FEATURES = [
    "decade",
    "tempo_energy",
    "dance_valence",
    "acoustic_energy",
    "loudness_energy",
    "speech_instrument",
    "duration_min",
    "log_duration",
]

SCORE_DEFAULTS = {
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
    "year": 2023,
    "genre_group": "Pop",
}
INPUT_RANGES = {
    "danceability": (0, 1),
    "energy": (0, 1),
    "valence": (0, 1),
    "acousticness": (0, 1),
    "speechiness": (0, 1),
    "instrumentalness": (0, 1),
    "liveness": (0, 1),
    "loudness": (-60, 0),
    "tempo": (40, 220),
    "duration_ms": (30_000, 600_000),
    "year": (2000, 2023),
}
TEMPO_SCALE_MAX = 220

# Texts a default pandas CSV reader takes for "missing".
PANDAS_NULL_TOKENS = [
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


RAW_TRACKS = _struct(
    ("track_id", _S),
    ("track_name", _S),
    ("artist_name", _S),
    ("genre", _S),
    ("popularity", _I),
    ("year", _I),
    ("danceability", _D),
    ("energy", _D),
    ("loudness", _D),
    ("tempo", _D),
    ("valence", _D),
    ("acousticness", _D),
    ("speechiness", _D),
    ("instrumentalness", _D),
    ("liveness", _D),
    ("duration_ms", _I),
    ("key", _I),
)

TRACKS = _struct(
    ("track_id", _S),
    ("track_name", _S),
    ("artist_name", _S),
    ("genre", _S),
    ("genre_group", _S),
    ("popularity", _I),
    ("popularity_tier", _S),
    ("year", _I),
    ("danceability", _D),
    ("energy", _D),
    ("loudness", _D),
    ("tempo", _D),
    ("valence", _D),
    ("acousticness", _D),
    ("speechiness", _D),
    ("instrumentalness", _D),
    ("liveness", _D),
    ("duration_ms", _I),
)

MUSIC_TRENDS = _struct(
    ("year", _I),
    ("avg_energy", _D),
    ("avg_danceability", _D),
    ("avg_acousticness", _D),
    ("avg_valence", _D),
    ("avg_popularity", _D),
    ("track_count", _L),
)

GENRE_STATS = _struct(
    ("genre_group", _S),
    ("avg_popularity", _D),
    ("avg_danceability", _D),
    ("avg_energy", _D),
    ("avg_valence", _D),
    ("track_count", _L),
)

MOOD_MAP = _struct(
    ("genre_group", _S),
    ("avg_energy", _D),
    ("avg_valence", _D),
    ("track_count", _L),
)

ARTIST_PROFILES = _struct(
    ("artist_name", _S),
    ("origin_country", _S),
    ("career_start", _I),
    ("style_description", _S),
    ("fun_fact", _S),
    ("audio_analysis", _S),
    ("career_insight", _S),
    ("similar_artists", _S),
    ("signature_sound", _S),
    ("generated_at", T.TimestampType()),
)

PRIMARY_KEYS = {
    "tracks": "track_id",
    "music_trends": "year",
    "genre_stats": "genre_group",
    "mood_map": "genre_group",
    "artist_profiles": "artist_name",
}

# Longest text each bounded column of the serving tables may hold.
LENGTH_LIMITS = {
    "tracks": {"track_id": 100, "genre": 100, "genre_group": 50, "popularity_tier": 10},
    "genre_stats": {"genre_group": 50},
    "mood_map": {"genre_group": 50},
    "artist_profiles": {"artist_name": 200, "origin_country": 100, "signature_sound": 200},
}
