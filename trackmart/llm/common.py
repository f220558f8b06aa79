"""Helpers the operators share: reading, staging, column names, cached word maps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trackmart.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word is a run of anything but the ASCII space and the controls \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of an Arrow batch that goes to a worker. Both sides hold it whole, once for each task.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder; see :func:`materialize`."""
    return materialize(df, label)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` does just that where every character is one byte; ``translate`` looks
    up each character and is kept for the other texts.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def folds(id_column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % n


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def exact(name: str) -> Column:
    """A column by its name as it stands, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    """Arrow schema for batches built in workers."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return to_arrow_schema(struct)


def sliced(batch: pa.RecordBatch, budget: int = BATCH_BYTES):
    """``batch`` in slices of about ``budget`` bytes, so that a worker never holds the texts
    of a whole batch as Python objects. An empty batch is one empty slice."""
    rows = max(1, batch.num_rows * budget // max(batch.nbytes, 1))
    for at in range(0, max(batch.num_rows, 1), rows):
        yield batch.slice(at, rows)


def give_back() -> None:
    """Return what a task has freed to the system: workers live on, and what they keep adds up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def map_arrow(
    df: DataFrame,
    per_batch: Callable,
    schema: str,
    setup: Callable | None = None,
    at_end: Callable | None = None,
):
    """Map ``df`` batch by batch.

    ``per_batch(batch, state)`` gets a record batch and yields lists of columns in
    the order of ``schema``. ``setup()`` makes the state of one task, and
    ``at_end(state)`` yields what is left when its rows are over.

    Where the session does not set the size of Arrow batches, it is set to ``BATCH_BYTES``:
    Spark's own 10,000 rows or 64 MB are held by the executor and by the worker, for each
    task. The setting stays, as plans are made when a frame is run.
    """
    target = arrow_schema(schema)
    settings = df.sparkSession.conf
    if settings.get(BATCH_SETTING, None) is None:
        settings.set(BATCH_SETTING, str(BATCH_BYTES))

    def run(batches):
        state = setup() if setup else None
        try:
            yield from arranged(batches, state)
        finally:
            state = None
            give_back()

    def arranged(batches, state):
        found = (c for batch in batches for own in sliced(batch) for c in per_batch(own, state))
        for columns in chain(found, at_end(state) if at_end else ()):
            arrays = [
                c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                for c, f in zip(columns, target, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    # Batches are read by position; plain names spare columns with dots in theirs.
    plain = df.toDF(*[f"c{n}" for n in range(len(df.columns))])
    return plain.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class Lookup(dict):
    """Numbers the distinct keys it is asked for and keeps ``make(key)`` for each.

    ``indices`` maps keys to row numbers of ``values``. The table is emptied when it
    has grown past ``limit``, so a worker's memory stays bounded on any vocabulary;
    results do not depend on when that happens.
    """

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit, self.values = make, limit, []

    def __missing__(self, key):
        self[key] = row = len(self.values)
        self.values.append(self.make(key))
        return row

    def trim(self) -> None:
        if len(self.values) > self.limit:
            self.clear()
            self.values.clear()

    def indices(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class Table(Lookup):
    """A :class:`Lookup` whose values are rows of numbers, kept in the array ``rows``."""

    def __init__(self, make: Callable, width: int, limit: int = 400_000, dtype=np.float64):
        super().__init__(make, limit)
        self.rows = np.zeros((1024, width), dtype)

    def __missing__(self, key):
        self[key] = row = len(self.values)
        self.values.append(None)
        if row == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[row] = self.make(key)
        return row


class BatchTable(Lookup):
    """A :class:`Table` whose new keys are described all at once: ``make(keys)`` gives their rows."""

    def __init__(self, make: Callable, width: int, limit: int = 400_000):
        super().__init__(None, limit)
        self.make_rows, self.rows = make, np.zeros((1024, width))

    def __missing__(self, key):
        self[key] = row = len(self.values)
        self.values.append(key)
        return row

    def indices(self, keys: list) -> np.ndarray:
        known = len(self.values)
        found = super().indices(keys)
        new = self.values[known:]
        if new:
            while len(self.rows) < len(self.values):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[known : len(self.values)] = self.make_rows(new)
        return found


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def portions(texts: list[bytes], budget: int = 2 << 20):
    """Slices (first, last) of ``texts`` of about ``budget`` bytes, so that the words of
    a whole batch are never all in memory as Python objects."""
    first, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text)
        if size >= budget:
            yield first, n + 1
            first, size = n + 1, 0
    if first < len(texts):
        yield first, len(texts)
