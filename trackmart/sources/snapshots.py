"""Published tables: immutable snapshots and a manifest naming the current one.

A refresh writes a new snapshot folder and then appends one manifest row. Readers
resolve the manifest first, so they see the old table or the new one, never an
empty or half-written one, and a plan may read a table it is about to replace.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = "version string, published_at timestamp"


def snapshot_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/snapshots/{version}"


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def current_version(spark: SparkSession, root: str) -> str | None:
    try:
        manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path(root))
        last = manifest.orderBy(F.desc("published_at"), F.desc("version")).first()
    except AnalysisException:
        return None
    return last["version"] if last else None


def read_table(
    spark: SparkSession, root: str, schema: T.StructType | None = None
) -> DataFrame:
    """The current snapshot of a published table."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published snapshot under {root}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(snapshot_path(root, version))
