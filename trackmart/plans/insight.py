"""Artist reports in batch: find stored profiles, prompt for the rest, merge replies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from trackmart.operators import artists, profiles


@dataclass(frozen=True)
class Merged:
    profiles: DataFrame
    rejected: DataFrame


def pending_prompts(tracks: DataFrame, stored: DataFrame) -> DataFrame:
    """Prompts for the artists that have no stored profile yet.

    Artists with a profile are left out of the tracks before anything is aggregated.
    """
    missing = artists.profiles_missing(tracks, stored)
    return profiles.profile_prompts(artists.artist_overview(missing))


def merge_replies(stored: DataFrame, parsed: DataFrame) -> Merged:
    """Stored profiles with parsed replies merged in, and the unusable replies.

    ``parsed`` comes from :func:`read_replies` and is read twice: stage it first.
    """
    merged = profiles.profile_upsert(stored, profiles.accepted(parsed))
    return Merged(merged, profiles.quarantine(parsed))


def read_replies(stats: DataFrame, replies: DataFrame) -> DataFrame:
    """Replies parsed against the artist statistics mart."""
    return profiles.parse_replies(replies, artists.primary_genre(stats))
