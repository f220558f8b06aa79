"""Tables with one row per key, kept in buckets and changed by commits.

Rows are dealt to buckets by a hash of the key. A change writes new files for the buckets it
touches, which no reader sees, and then one commit: a small file that lists the folders of
every bucket. Readers take the commit with the highest number, so they see the table before
or after a change. Commit files are created only if they do not exist yet: of two writers
that started from the same commit one gets the next number, and the other starts over from
what that one left. A batch id is committed once; repeating it changes nothing, and files of
a failed attempt are never listed.

An append reads the keys of the buckets that its batch touches, an upsert reads and rewrites
those buckets; neither touches the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.operators.cleaning import dedupe

BUCKETS = 64
BUCKET = "_bucket"
MOST_FOLDERS = 16  # of one bucket; the next append joins them into one


@dataclass(frozen=True)
class State:
    """What a commit says: its number, key, number of buckets, schema, folders of each bucket,
    batches, and marks, which are the caller's own."""

    number: int
    key: str
    buckets: int
    schema: str
    folders: dict[int, list[str]] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)
    marks: dict[str, str] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Other writers kept committing first."""


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def commit_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/commits/{number:012d}.json"


def state(spark: SparkSession, root: str) -> State | None:
    """The latest commit, or None where nothing has been committed."""
    folder, files = _files(spark, f"{root.rstrip('/')}/commits")
    if not files.exists(folder):
        return None
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    # A commit being written ends in .tmp until it is complete.
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not numbers:
        return None
    text = spark.read.text(commit_path(root, max(numbers)), wholetext=True).first()[0]
    found = json.loads(text)
    return State(**{**found, "folders": {int(b): own for b, own in found["folders"].items()}})


def commit(spark: SparkSession, root: str, new: State) -> bool:
    """Write a commit file; False if its number is taken."""
    target, files = _files(spark, commit_path(root, new.number))
    staged, _ = _files(spark, f"{commit_path(root, new.number)}.{uuid.uuid4().hex}.tmp")
    out = files.create(staged, False)
    out.write(bytearray(json.dumps(new.__dict__).encode()))
    out.close()
    rename = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    none = spark._sc._gateway.new_array(rename, 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(staged, target, none)  # unlike FileSystem.rename, never replaces a file
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception):
            raise
        files.delete(staged, False)
        return False
    return True


def create(spark: SparkSession, root: str, schema: str, key: str, buckets: int = BUCKETS) -> None:
    """An empty table, unless there is one already."""
    if state(spark, root) is None:
        commit(spark, root, State(0, key, buckets, schema))


def read(spark: SparkSession, root: str, only: Sequence[int] | None = None) -> DataFrame:
    """The table as of its latest commit, or those of its buckets that are in ``only``."""
    now = state(spark, root)
    if now is None:
        raise FileNotFoundError(f"no table under {root}")
    return rows_of(spark, root, now, only)


def rows_of(spark: SparkSession, root: str, now: State, only: Sequence[int] | None) -> DataFrame:
    wanted = now.folders if only is None else {b: now.folders.get(b, []) for b in only}
    paths = [f"{root.rstrip('/')}/data/{name}" for own in wanted.values() for name in own]
    if not paths:
        return spark.createDataFrame([], now.schema)
    return spark.read.schema(now.schema).parquet(*paths)


def bucket_of(now: State) -> Column:
    return F.pmod(F.xxhash64(F.col(now.key)), F.lit(now.buckets)).cast("int")


def _change(
    spark: SparkSession,
    root: str,
    batch: str,
    incoming: DataFrame,
    rows_for: Callable[[State, list[int]], DataFrame],
    rewrites: Callable[[State, int], bool],
    attempts: int,
) -> bool:
    """Write what ``rows_for`` makes of the touched buckets and commit it."""
    for _ in range(attempts):
        now = state(spark, root)
        if now is None:
            raise FileNotFoundError(f"no table under {root}")
        if batch in now.batches:
            return False
        keyed = incoming.where(F.col(now.key).isNotNull()).select(bucket_of(now).alias(BUCKET))
        touched = sorted(r[0] for r in keyed.distinct().collect())  # one row per bucket at most
        attempt = f"{batch}-{uuid.uuid4().hex}"
        rows = rows_for(now, touched).withColumn(BUCKET, bucket_of(now))
        path = f"{root.rstrip('/')}/data/{attempt}"
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        written = written_buckets(spark, path)
        folders = {b: list(own) for b, own in now.folders.items()}
        for b in touched:
            new = [f"{attempt}/{BUCKET}={b}"] if b in written else []
            folders[b] = new if rewrites(now, b) else folders.get(b, []) + new
        new = replace(now, number=now.number + 1, folders=folders, batches=[*now.batches, batch])
        if commit(spark, root, new):
            return True
    raise Conflict(f"batch {batch}: another writer committed first, {attempts} times")


def written_buckets(spark: SparkSession, path: str) -> set[int]:
    folder, files = _files(spark, path)
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    return {int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}=")}


def append_absent(
    incoming: DataFrame,
    root: str,
    batch: str,
    tie_breakers: Sequence[str] | None = None,
    attempts: int = 5,
) -> bool:
    """Add the rows whose key the table does not hold, one per key; False if ``batch`` is done.

    Rows without a key are left out. Only the key column of touched buckets is read, but for
    buckets of ``MOST_FOLDERS`` folders, which are joined into one.
    """
    spark = incoming.sparkSession

    def full(now: State, bucket: int) -> bool:
        return len(now.folders.get(bucket, [])) >= MOST_FOLDERS

    def rows_for(now: State, touched: list[int]) -> DataFrame:
        names = spark.createDataFrame([], now.schema).columns
        fresh = dedupe(incoming.where(F.col(now.key).isNotNull()), now.key, tie_breakers).select(names)
        held = rows_of(spark, root, now, touched).select(now.key)
        absent = fresh.join(held, now.key, "left_anti").select(names)
        return absent.unionByName(rows_of(spark, root, now, [b for b in touched if full(now, b)]))

    return _change(spark, root, batch, incoming, rows_for, full, attempts)


def upsert(
    incoming: DataFrame,
    root: str,
    batch: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    attempts: int = 5,
) -> bool:
    """Rewrite the touched buckets as ``merge(stored, incoming)``; False if ``batch`` is done.

    ``merge`` gets the stored rows of these buckets. Rows without a key are left out.
    """
    spark = incoming.sparkSession

    def rows_for(now: State, touched: list[int]) -> DataFrame:
        stored = rows_of(spark, root, now, touched)
        return merge(stored, incoming.where(F.col(now.key).isNotNull()).select(stored.columns))

    return _change(spark, root, batch, incoming, rows_for, lambda now, bucket: True, attempts)
