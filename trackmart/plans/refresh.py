"""Refresh the states of the marts for the years that changed, and for no others."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.operators import states
from trackmart.session import releasing
from trackmart.sinks import keyed
from trackmart.sources.fingerprint import part_fingerprints

YEAR = "year"


def refresh_states(tracks: DataFrame, root: str, attempts: int = 5) -> list[int]:
    """Bring the stored states up to ``tracks``; the years that were written or dropped.

    Fingerprints of the years are kept in the commit that their states belong to, so states
    and fingerprints never disagree. Tracks without a year take no part. States of a year are
    one folder, so a year that changed is read and written alone; ``tracks`` should be stored
    by year.
    """
    spark = tracks.sparkSession
    dated = tracks.where(F.col(YEAR).isNotNull())
    found = part_fingerprints(dated, YEAR).collect()  # a row per year
    marks = {r["part"]: f"{r['row_count']}:{r['checksum']}" for r in found}
    for _ in range(attempts):
        now = keyed.state(spark, root)
        if now is None:
            keyed.create(spark, root, _schema(dated), YEAR)
            now = keyed.state(spark, root)
        changed = sorted(int(y) for y in marks if now.marks.get(y) != marks[y])
        gone = sorted(int(y) for y in now.marks if y not in marks)
        if not changed and not gone:
            return []
        attempt = f"refresh-{uuid.uuid4().hex}"
        folders = {y: own for y, own in now.folders.items() if y not in gone}
        if changed:
            with releasing(spark):
                rows = states.track_states(dated.where(F.col(YEAR).isin(changed)))
                keyed_rows = rows.withColumn(keyed.BUCKET, F.col(YEAR))
                # Written as the aggregate has dealt them: about as many states as tracks are not
                # shuffled again for fewer files a year.
                keyed_rows.write.partitionBy(keyed.BUCKET).parquet(f"{root.rstrip('/')}/data/{attempt}")
            folders |= {y: [f"{attempt}/{keyed.BUCKET}={y}"] for y in changed}
        new = replace(now, number=now.number + 1, folders=folders, batches=[*now.batches, attempt], marks=marks)
        if keyed.commit(spark, root, new):
            return sorted([*changed, *gone])
    raise keyed.Conflict(f"another writer refreshed {root} first, {attempts} times")


def read_states(spark: SparkSession, root: str) -> DataFrame:
    return keyed.read(spark, root)


def _schema(tracks: DataFrame) -> str:
    return ", ".join(f"`{n}` {kind}" for n, kind in states.track_states(tracks).dtypes)
