"""Skip work on unchanged input."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.functions import row_digest

MANIFEST_SCHEMA = "row_count bigint, checksum string, saved_at timestamp"


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and checksum of a table, whatever its row order or partitioning.

    Row digests are summed, so repeated rows count. All 128 bits of a digest enter, as
    eight parts summed apart, plain longs that fit for any number of rows. A single
    shuffle-free aggregate.
    """
    hashed = df.select(row_digest(df.columns).alias("digest"))
    return hashed.agg(*_digest_sums())


def part_fingerprints(df: DataFrame, by: str = "year") -> DataFrame:
    """:func:`table_fingerprint` of every part of a table: part (as text), row_count, checksum.

    One row per part and task is shuffled. Rows without a part make the part ``null``.
    """
    part = F.coalesce(F.col(by).cast("string"), F.lit("null")).alias("part")
    return df.select(part, row_digest(df.columns).alias("digest")).groupBy("part").agg(*_digest_sums())


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """part (a file's path), row_count (its bytes) and checksum (its time); no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("part"),
        F.col("length").alias("row_count"),
        F.col("modificationTime").cast("string").alias("checksum"),
    )


def changed_parts(current: DataFrame, recorded: DataFrame) -> DataFrame:
    """part, change (added, changed, removed) of the parts that differ between two listings."""
    before = recorded.select("part", F.struct("row_count", "checksum").alias("before"))
    now = current.select("part", F.struct("row_count", "checksum").alias("now"))
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("now").isNull(), "removed")
        .when(F.col("before") != F.col("now"), "changed")
    )
    joined = now.join(before, "part", "full").withColumn("change", change)
    return joined.where("change IS NOT NULL").select("part", "change")


def _digest_sums() -> list[Column]:
    # Three texts are parsed instead of eight; shifts then take the parts of 16 bits.
    longs = [(F.conv(F.substring("digest", a + 1, n), 16, 10).cast("bigint"), n) for a, n in ((0, 12), (12, 12), (24, 8))]
    parts = [F.shiftright(v, 4 * at).bitwiseAND(F.lit(0xFFFF)) for v, n in longs for at in range(n - 4, -1, -4)]
    sums = [F.coalesce(F.sum(part), F.lit(0)).cast("string") for part in parts]
    return [F.count(F.lit(1)).alias("row_count"), F.concat_ws("-", *sums).alias("checksum")]


def listing_fingerprint(spark: SparkSession, path: str) -> tuple[int, str]:
    """The same for names, sizes and times of the files in a folder; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return tuple(table_fingerprint(files.select("path", "length", "modificationTime")).first())


def last_recorded(spark: SparkSession, manifest: str) -> tuple[int, str] | None:
    """The fingerprint recorded last, if any."""
    try:
        entries = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
        last = entries.orderBy(F.desc("saved_at")).first()
    except AnalysisException:  # nothing recorded yet
        return None
    return (last["row_count"], last["checksum"]) if last else None


def record(
    spark: SparkSession, manifest: str, fingerprint: tuple[int, str], saved_at: datetime
) -> None:
    """Record a fingerprint, best once the work on its table is done."""
    entry = spark.createDataFrame([(*fingerprint, saved_at)], MANIFEST_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(manifest)
