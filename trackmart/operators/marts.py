"""Aggregate tables and the figures derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.functions import avg_rounded, round_exact


def _averages(columns: list[str], digits: int | None) -> list:
    return [avg_rounded(c, digits).alias(f"avg_{c}") for c in columns]


def music_trends(tracks: DataFrame, digits: int | None = None) -> DataFrame:
    """Yearly averages, in year order."""
    features = ["energy", "danceability", "acousticness", "valence", "popularity"]
    yearly = tracks.groupBy("year").agg(
        *_averages(features, digits), F.count(F.lit(1)).alias("track_count")
    )
    return yearly.orderBy("year")


def genre_stats(tracks: DataFrame, digits: int | None = None) -> DataFrame:
    """Averages per genre group, most popular first."""
    features = ["popularity", "danceability", "energy", "valence"]
    grouped = tracks.groupBy("genre_group").agg(
        *_averages(features, digits), F.count(F.lit(1)).alias("track_count")
    )
    return grouped.orderBy(F.desc("avg_popularity"), "genre_group")


def mood_map(tracks: DataFrame, digits: int | None = None) -> DataFrame:
    """Energy and valence per genre group."""
    return tracks.groupBy("genre_group").agg(
        *_averages(["energy", "valence"], digits), F.count(F.lit(1)).alias("track_count")
    )


def genre_distribution(tracks: DataFrame) -> DataFrame:
    grouped = tracks.groupBy("genre_group").agg(F.count(F.lit(1)).alias("track_count"))
    return grouped.orderBy(F.desc("track_count"), "genre_group")


def label_distribution(tracks: DataFrame, label: str = "popularity_tier") -> DataFrame:
    """Class counts and their shares of the total."""
    counted = tracks.groupBy(label).agg(F.count(F.lit(1)).alias("track_count"))
    total = counted.select(F.sum("track_count")).scalar()
    share = round_exact(F.col("track_count") * 100 / total, 4)
    return counted.withColumn("pct", share).orderBy(F.desc("track_count"), label)


def trend_kpis(trends: DataFrame) -> DataFrame:
    """Headline figures of the yearly mart."""
    return trends.agg(
        F.count(F.lit(1)).alias("years_covered"),
        F.max("year").alias("latest_year"),
        F.max_by("avg_popularity", "year").alias("latest_avg_popularity"),
        F.sum("track_count").alias("total_tracks"),
        F.min("year").alias("earliest_year"),
        F.min_by("avg_popularity", "year").alias("earliest_avg_popularity"),
    )


def top_genre(stats: DataFrame) -> DataFrame:
    """The genre group with the highest average popularity."""
    return stats.orderBy(F.desc("avg_popularity"), "genre_group").limit(1)


def genre_radar(stats: DataFrame) -> DataFrame:
    """Four comparable 0–1 metrics per genre group, one row each."""
    scaled = stats.select(
        "genre_group",
        round_exact(F.col("avg_popularity") / 100, 3).alias("Popularity"),
        round_exact(F.col("avg_danceability"), 3).alias("Danceability"),
        round_exact(F.col("avg_energy"), 3).alias("Energy"),
        round_exact(F.col("avg_valence"), 3).alias("Valence"),
    )
    metrics = ["Popularity", "Danceability", "Energy", "Valence"]
    return scaled.unpivot("genre_group", metrics, "metric", "value")
