"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution coalesces small shuffle partitions and splits skewed ones, but
# starts from spark.sql.shuffle.partitions and never exceeds it: give build_session a
# number that suits the input, about one per 200 MB of shuffled data.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "trackmart", **conf: str) -> SparkSession:
    """Session with the library defaults; explicit ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="trackmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a session in one process may do without the setting: a folder on one
    machine is no use to executors elsewhere.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """What is planned and written in this block leaves no shuffle files once it is written.

    Otherwise they stay until the driver happens to collect its garbage, and those of all
    steps lie on disk at the same time. For frames made in the block, each written once.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For frames several jobs read. Unlike a cache, the written table outlives
    lost executors and cuts the lineage behind it. It stays until the scratch
    folder is cleared; use :func:`staged` where its end is known.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`materialize` for the length of a block; the table is then deleted."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
