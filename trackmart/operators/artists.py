"""Per-artist statistics, rankings, search and reports.

Names match without regard to case. Every batch join uses the lower-cased name
as an equality key, with one row per key on at least one side.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import avg_rounded, name_key, round_exact

# Decimals each average is published with.
STAT_DIGITS = {
    "popularity": 1,
    "danceability": 3,
    "energy": 3,
    "valence": 3,
    "acousticness": 3,
    "tempo": 1,
    "loudness": 2,
    "instrumentalness": 3,
    "speechiness": 3,
    "liveness": 3,
    "duration_ms": 0,
}
DETAIL_OMITS = ["avg_loudness", "avg_liveness", "avg_duration_ms"]
PROFILE_FIELDS = [f for f in S.ARTIST_PROFILES.fieldNames() if f != "artist_name"]


def artist_stats(tracks: DataFrame) -> DataFrame:
    """17 columns per (artist, genre group)."""
    return tracks.groupBy("artist_name", "genre_group").agg(
        *[avg_rounded(c, n).alias(f"avg_{c}") for c, n in STAT_DIGITS.items()],
        F.count(F.lit(1)).alias("track_count"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.max("popularity").alias("peak_popularity"),
    )


def artist_search(stats: DataFrame, term: str, k: int = 10, literal: bool = False) -> DataFrame:
    """Top ``k`` rows by average popularity whose artist name contains the term.

    ``%`` and ``_`` in the term are wildcards unless ``literal``. The predicate is
    on a grouping column, so over a lazy :func:`artist_stats` it filters the scan.
    """
    return ranked_by_popularity(stats.filter(name_matches(term, literal)), k)


def name_matches(term: str, literal: bool = False) -> Column:
    """Whether the artist name contains the term."""
    name = name_key()
    term = term.lower()
    return name.contains(term) if literal else name.like(_plain_escapes(f"%{term}%"))


def ranked_by_popularity(stats: DataFrame, k: int) -> DataFrame:
    return stats.orderBy(F.desc("avg_popularity"), "artist_name", "genre_group").limit(k)


def _plain_escapes(pattern: str) -> str:
    """Drop backslashes that escape nothing special; Spark rejects such patterns."""
    return re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], pattern)


def artist_detail(stats: DataFrame, name: str | None = None) -> DataFrame:
    """The 14 report columns, for one artist or for all."""
    wanted = stats if name is None else stats.filter(name_key() == name.lower())
    return wanted.drop(*DETAIL_OMITS)


def top_tracks_per_artist(tracks: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most popular tracks of every artist, ties broken by track id.

    The rank bound is also applied before the shuffle, so an artist owning a
    large share of the catalogue sends ``k`` rows per map task.
    """
    window = Window.partitionBy("artist_key").orderBy(F.desc("popularity"), "track_id")
    keyed = tracks.select(
        name_key().alias("artist_key"), "artist_name", "track_id", "track_name", "popularity", "year"
    )
    return keyed.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def primary_genre(stats: DataFrame) -> DataFrame:
    """One statistics row per artist key: most tracks, then genre, then name."""
    window = Window.partitionBy("artist_key").orderBy(
        F.desc("track_count"), "genre_group", "artist_name"
    )
    keyed = stats.withColumn("artist_key", name_key())
    return keyed.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _top_track_lists(tracks: DataFrame, k: int) -> DataFrame:
    """Top tracks gathered per artist key: at most ``k`` entries, in rank order."""
    entry = F.struct("rank", "track_name", "popularity", "year")
    gathered = top_tracks_per_artist(tracks, k).groupBy("artist_key").agg(
        F.array_sort(F.collect_list(entry)).alias("_ranked")
    )
    plain = F.transform(
        "_ranked",
        lambda t: F.struct(
            t["track_name"].alias("track_name"),
            t["popularity"].alias("popularity"),
            t["year"].alias("year"),
        ),
    )
    return gathered.select("artist_key", plain.alias("top_tracks"))


def artist_overview(tracks: DataFrame, k: int = 5) -> DataFrame:
    """Primary statistics row of every artist with its top tracks."""
    stats = artist_detail(primary_genre(artist_stats(tracks)))
    return stats.join(_top_track_lists(tracks, k), "artist_key", "left")


def latest_profiles(profiles: DataFrame) -> DataFrame:
    """One stored profile per artist key, the most recently generated."""
    window = Window.partitionBy("artist_key").orderBy(F.desc("generated_at"), "artist_name")
    keyed = profiles.withColumn("artist_key", name_key())
    ranked = keyed.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return ranked.select("artist_key", *PROFILE_FIELDS)


def artist_report(tracks: DataFrame, profiles: DataFrame, k: int = 5) -> DataFrame:
    """Statistics, top tracks and stored profile of every artist.

    ``cached`` tells whether a profile was stored; its columns are null otherwise.
    """
    stored = latest_profiles(profiles).withColumn("_stored", F.lit(True))
    report = artist_overview(tracks, k).join(stored, "artist_key", "left")
    return report.withColumns(
        {
            "similar_artists": F.from_json("similar_artists", "array<string>"),
            "cached": F.coalesce("_stored", F.lit(False)),
        }
    ).drop("_stored", "artist_key")


def _distinct_keys(names: DataFrame) -> DataFrame:
    return names.select(name_key().alias("artist_key")).distinct()


def profiles_cached(artists: DataFrame, profiles: DataFrame) -> DataFrame:
    """Artists that already have a stored profile."""
    keyed = artists.withColumn("artist_key", name_key())
    found = keyed.join(_distinct_keys(profiles), "artist_key", "left_semi")
    return found.drop("artist_key")


def profiles_missing(artists: DataFrame, profiles: DataFrame) -> DataFrame:
    """Artists whose profile has yet to be generated."""
    keyed = artists.withColumn("artist_key", name_key())
    missing = keyed.join(_distinct_keys(profiles), "artist_key", "left_anti")
    return missing.drop("artist_key")


def artists_not_found(requests: DataFrame, tracks: DataFrame) -> DataFrame:
    """Requested names no track belongs to, with how often each was asked for.

    Both sides are reduced to one row per key before they meet, so neither a
    popular request nor a prolific artist weighs on the join.
    """
    asked = requests.groupBy(name_key().alias("artist_key")).agg(
        F.count(F.lit(1)).alias("request_count")
    )
    return asked.join(_distinct_keys(tracks), "artist_key", "left_anti")


def artist_radar(stats: DataFrame) -> DataFrame:
    """Five 0–1 metrics per statistics row, one row each."""
    sources = ["danceability", "energy", "valence", "acousticness", "speechiness"]
    labels = [s.capitalize() for s in sources]
    wide = stats.select(
        "artist_name",
        "genre_group",
        *[F.coalesce(f"avg_{s}", F.lit(0.0)).alias(n) for s, n in zip(sources, labels)],
    )
    return wide.unpivot(["artist_name", "genre_group"], labels, "metric", "value")


def audio_fingerprint(stats: DataFrame) -> DataFrame:
    """Bar lengths in percent of each metric's scale, capped at 100."""
    scales = {
        "danceability": 1,
        "energy": 1,
        "valence": 1,
        "acousticness": 1,
        "tempo": S.TEMPO_SCALE_MAX,
    }
    bars = [
        round_exact(F.least(F.col(f"avg_{c}") / top * 100, F.lit(100.0)), 4).alias(f"{c}_pct")
        for c, top in scales.items()
    ]
    return stats.select("artist_name", "genre_group", *bars)
