"""Clean raw tracks, gate them, and publish the detail table and the marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart import schemas as S
from trackmart.operators import artists, cleaning, marts, quality
from trackmart.session import staged
from trackmart.sinks import tables
from trackmart.sources.snapshots import read_table, snapshot_path
from trackmart.sources.tracks import nan_to_null, read_tracks_parquet

# Sort columns of each mart, a minus sign meaning descending.
PRESENTATION_ORDER = {
    "music_trends": ["year"],
    "genre_stats": ["-avg_popularity", "genre_group"],
    "mood_map": ["genre_group"],
    "artist_stats": ["artist_name", "genre_group"],
}


@dataclass(frozen=True)
class Published:
    version: str
    failed_raw_checks: list[str]
    tables: dict[str, str]


def clean_and_publish(
    raw: DataFrame,
    root: str,
    version: str,
    now: datetime,
    min_rows: int = S.MIN_ROWS,
    tie_breakers: Sequence[str] | None = None,
) -> Published:
    """Raw tracks to published tables under ``root``.

    The raw suite is advisory, unless columns are missing. Raw rows are deduplicated
    once, into a staged table that audit, uniqueness check and cleaned tracks come from.
    All tables are written as unannounced snapshots: tracks, which the blocking suite
    and the conformance check of the detail table read, and the marts built from them.
    Only when all are there do they become current.
    """
    spark = raw.sparkSession
    raw = nan_to_null(raw)
    if not set(S.REQUIRED_COLUMNS) <= set(raw.columns):
        with staged(quality.validate_raw(raw, min_rows), "raw-checks") as raw_checks:
            _report(raw_checks, root, "raw", now)
            quality.enforce(raw_checks, strict=True)

    with staged(cleaning.survivors(raw, tie_breakers), "survivors") as kept:
        audit = cleaning.audit_survivors(kept, raw.count())
        tables.write_report(audit, f"{root}/reports/cleaning_audit")
        duplicates = spark.read.json(f"{root}/reports/cleaning_audit").first()["duplicates_removed"]
        with staged(quality.validate_raw(raw, min_rows, duplicates), "raw-checks") as raw_checks:
            _report(raw_checks, root, "raw", now)
            failed_raw = quality.enforce(raw_checks, strict=False)
        cleaned = cleaning.cleaned_survivors(kept)
        paths = {"tracks": tables.stage(cleaned, f"{root}/tracks", version, partition_by="year")}
    tracks = read_tracks_parquet(spark, paths["tracks"])

    with staged(quality.validate_cleaned(tracks, min_rows), "cleaned-checks") as checks:
        _report(checks, root, "cleaned", now)
        quality.enforce(checks, strict=True)
    detail = cleaning.coerce_tracks(tracks)
    conform(detail, "tracks", S.TRACKS)
    paths["track_details"] = tables.stage(detail, f"{root}/track_details", version)

    for name, build in MARTS.items():
        paths[name] = tables.stage(build(tracks), f"{root}/{name}", version)
    # The mood map is part of the genre statistics and needs no pass of its own.
    genres = spark.read.parquet(paths["genre_stats"])
    paths["mood_map"] = tables.stage(
        genres.select(*S.MOOD_MAP.fieldNames()), f"{root}/mood_map", version
    )
    for name in paths:
        tables.announce(spark, f"{root}/{name}", version, now)
    return Published(version, failed_raw, paths)


MARTS = {
    "music_trends": marts.music_trends,
    "genre_stats": marts.genre_stats,
    "artist_stats": artists.artist_stats,
}


def conform(table: DataFrame, name: str, schema: T.StructType) -> None:
    """Raise unless a table has its declared columns, keys and text lengths."""
    problems = quality.schema_mismatches(table, schema)
    broken = quality.conformance(table, S.PRIMARY_KEYS[name], S.LENGTH_LIMITS[name])
    problems += [
        f"{r['constraint']}: {r['violations']} values"
        for r in broken.filter("violations > 0").collect()
    ]
    if problems:
        raise quality.ValidationError(f"{name}: {'; '.join(problems)}")


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current snapshot of a published mart, in its presentation order."""
    order = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in PRESENTATION_ORDER[name]]
    return read_table(spark, f"{root}/{name}").orderBy(*order)


def _report(checks: DataFrame, root: str, stage: str, now: datetime) -> None:
    # Written before the gate, so a failed run still leaves its report.
    tables.write_report(tables.validation_document(checks, now), f"{root}/reports/{stage}")
