"""Mergeable states of the marts: exact sums and counts, from which any average follows.

A state row holds, for one year, artist and genre group, the number of tracks and, for every
feature, how many values it has and their exact decimal sum. States of different years add up
to those of all years whatever the order, so that a mart built from stored states is the one
built from all tracks, to the last bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.functions import round_exact
from trackmart.operators.artists import STAT_DIGITS

FEATURES = list(STAT_DIGITS)
GRAIN = ["year", "artist_name", "genre_group"]
# Twelve decimals; sums of 10**14 values below 10**12 still fit 38 digits.
EXACT = "decimal(28,12)"


def track_states(tracks: DataFrame) -> DataFrame:
    """One state row per year, artist and genre group."""
    values = {c: F.col(c).try_cast(EXACT) for c in FEATURES}
    return tracks.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("track_count"),
        F.max("popularity").alias("peak_popularity"),
        *[F.count(v).alias(f"n_{c}") for c, v in values.items()],
        *[F.sum(v).cast("decimal(38,12)").alias(f"sum_{c}") for c, v in values.items()],
    )


def merged(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States added up over everything but ``by``; with the first and last year."""
    return states.groupBy(*by).agg(
        F.sum("track_count").alias("track_count"),
        F.max("peak_popularity").alias("peak_popularity"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in FEATURES],
        *[F.sum(f"sum_{c}").cast("decimal(38,12)").alias(f"sum_{c}") for c in FEATURES],
    )


def average(feature: str, digits: int | None = None) -> Column:
    """The mean of a feature; null where it has no value."""
    mean = F.try_divide(F.col(f"sum_{feature}").cast("double"), F.col(f"n_{feature}"))
    return (mean if digits is None else round_exact(mean, digits)).alias(f"avg_{feature}")


def music_trends(states: DataFrame, digits: int | None = None) -> DataFrame:
    """Yearly averages, in year order."""
    features = ["energy", "danceability", "acousticness", "valence", "popularity"]
    averages = [average(c, digits) for c in features]
    # "year" is also what the merge takes first and last of: it groups by a copy.
    yearly = merged(states.withColumn("of_year", F.col("year")), ["of_year"])
    return yearly.select(F.col("of_year").alias("year"), *averages, "track_count").orderBy("year")


def genre_stats(states: DataFrame, digits: int | None = None) -> DataFrame:
    """Averages per genre group, most popular first."""
    features = ["popularity", "danceability", "energy", "valence"]
    by_genre = merged(states, ["genre_group"])
    found = by_genre.select("genre_group", *[average(c, digits) for c in features], "track_count")
    return found.orderBy(F.desc("avg_popularity"), "genre_group")


def mood_map(states: DataFrame, digits: int | None = None) -> DataFrame:
    """Energy and valence per genre group."""
    by_genre = merged(states, ["genre_group"])
    return by_genre.select("genre_group", average("energy", digits), average("valence", digits), "track_count")


def artist_stats(states: DataFrame) -> DataFrame:
    """17 columns per artist and genre group."""
    return merged(states, ["artist_name", "genre_group"]).select(
        "artist_name",
        "genre_group",
        *[average(c, n) for c, n in STAT_DIGITS.items()],
        "track_count",
        "first_year",
        "last_year",
        "peak_popularity",
    )
