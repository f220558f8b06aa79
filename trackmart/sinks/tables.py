"""Writing tables, partitions, reports and database copies."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.operators.cleaning import dedupe
from trackmart.operators.quality import validation_summary
from trackmart.sources.snapshots import MANIFEST_SCHEMA, manifest_path, snapshot_path


def write_partitioned(df: DataFrame, path: str, by: str = "year", mode: str = "overwrite") -> None:
    """Parquet with one folder per value of ``by``.

    Rebalancing groups a value's rows into few files, and splits a value that
    holds much of the table over many tasks; a plain repartition by the column
    would give each value one task.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def publish(
    df: DataFrame,
    root: str,
    version: str,
    published_at: datetime,
    partition_by: str | None = None,
) -> str:
    """Full refresh: write a new snapshot, then make it the current one."""
    path = stage(df, root, version, partition_by)
    announce(df.sparkSession, root, version, published_at)
    return path


def stage(df: DataFrame, root: str, version: str, partition_by: str | None = None) -> str:
    """Write a snapshot without making it current. Re-running a version replaces it."""
    path = snapshot_path(root, version)
    if partition_by:
        write_partitioned(df, path, partition_by)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def announce(spark: SparkSession, root: str, version: str, published_at: datetime) -> None:
    """Make a staged snapshot the current one."""
    row = spark.createDataFrame([(version, published_at)], MANIFEST_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(manifest_path(root))


def absent_rows(
    incoming: DataFrame,
    existing: DataFrame,
    key: str = "track_id",
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Incoming rows, one per key, whose key the existing table does not hold.

    Only keys of the existing table are read.
    """
    fresh = dedupe(incoming, key, tie_breakers)
    return fresh.join(existing.select(key).distinct(), key, "left_anti").select(incoming.columns)


def insert_if_absent(
    incoming: DataFrame,
    existing: DataFrame,
    key: str = "track_id",
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The existing table with absent rows appended."""
    return existing.unionByName(absent_rows(incoming, existing, key, tie_breakers))


def append_absent(
    incoming: DataFrame,
    path: str,
    key: str = "track_id",
    tie_breakers: Sequence[str] | None = None,
    partition_by: str = "year",
) -> None:
    """Append the absent rows to a stored table; running it again adds nothing."""
    existing = incoming.sparkSession.read.parquet(path)
    fresh = absent_rows(incoming, existing, key, tie_breakers)
    write_partitioned(fresh, path, partition_by, mode="append")


def write_report(df: DataFrame, path: str) -> None:
    """A report-sized frame as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def validation_document(checks: DataFrame, generated_at: datetime) -> DataFrame:
    """A suite's outcome as one nested row: totals, rate and the list of checks."""
    listed = checks.groupBy("stage").agg(
        F.array_sort(F.collect_list(F.struct("position", "check", "passed"))).alias("_all")
    )
    plain = F.transform(
        "_all", lambda c: F.struct(c["check"].alias("check"), c["passed"].alias("passed"))
    )
    summary = validation_summary(checks).withColumn("timestamp", F.lit(generated_at))
    return summary.join(listed.select("stage", plain.alias("checks")), "stage")


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8
) -> None:
    """Full refresh of a database table, keeping its definition.

    Executors write in parallel over a bounded number of connections.
    """
    writer = df.write.mode("overwrite").option("truncate", True)
    writer.option("numPartitions", connections).jdbc(url, table, properties=properties)
