"""Reversible line dedup: exact reference counts, sharded cuckoo filters before them.

The index is two tables. ``counts`` holds, for every line key, the exact number of
documents that have it; adding documents adds to it, deleting documents subtracts, so
any deletion undoes its insertion. ``filters`` holds a cuckoo filter for each shard of
the key space with the keys that have reached the threshold; keys enter and leave it as
their counts cross the threshold, which a cuckoo filter supports and a Bloom filter
does not.

Lines meet the filters where both are dealt: the hashes of lines go to the shard of their
key and one of ``SALTS`` copies of its filter, so that a line of very many documents is
spread, and are probed in passing. What a filter lets through is settled against the exact
counts, so filters save work and decide nothing. Texts are read twice and never wait for
the probing: lines are known by their document's id and text hash, and their place in it.

Rules
-----
* A document is split at line feeds; null or empty text is one empty line.
* A key is the line stripped of ASCII white space with A-Z lower-cased; keys under
  ``min_length`` code points are never dropped. Keys are compared by a 128-bit hash.
* A line repeated within a document counts once for it and is dropped everywhere.
* Repeated rows count as documents of their own; an empty table gives an empty index
  and result. Other columns are not read and may have any name.
* Deleting documents that were never inserted raises :class:`NotInserted` where a count
  would fall below zero; the index passed in stays as it was.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import documents, exact, map_arrow, ragged, utf8, written

MIN_LENGTH, MIN_DOCS = 1, 10
KEYS_PER_SHARD = 50_000
SALTS = 16  # copies of a shard's filter, each probed by a part of its lines
SLOTS, KICKS = 4, 200


class Index(NamedTuple):
    counts: DataFrame  # h1, h2, refs
    filters: DataFrame  # shard, cells, stash
    shards: int
    min_docs: int
    min_length: int


class NotInserted(ValueError):
    """Documents to be deleted from an index that does not hold them."""


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each has two buckets it may lie in.

    An entry that finds no place after ``KICKS`` moves goes to a small stash, so that
    nothing inserted is ever lost.
    """

    def __init__(self, cells: np.ndarray, stash: list[int] | None = None):
        self.cells = cells.reshape(-1, SLOTS)
        self.stash = [] if stash is None else [int(entry) for entry in stash]

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(2 * keys / SLOTS).bit_length())
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    def _places(self, h1, h2):
        mask = np.uint64(len(self.cells) - 1)
        mark = (h2.astype(np.uint64) & np.uint64(0xFFFF)).astype(np.uint64)
        mark = np.where(mark == 0, np.uint64(1), mark)
        first = (h1.astype(np.uint64) >> np.uint64(20)) & mask
        return mark, first, first ^ self._jump(mark, mask)

    @staticmethod
    def _jump(mark, mask):
        return (mark * np.uint64(0x5BD1E995)) & mask

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> None:
        mask = np.uint64(len(self.cells) - 1)
        for mark, a, b in zip(*(x.tolist() for x in self._places(h1, h2)), strict=True):
            at = a if 0 in self.cells[a] or 0 not in self.cells[b] else b
            for kick in range(KICKS):
                bucket = self.cells[at]
                free = np.flatnonzero(bucket == 0)
                if len(free):
                    bucket[free[0]] = mark
                    break
                slot = (mark + kick) % SLOTS
                mark, bucket[slot] = int(bucket[slot]), mark
                at = int(np.uint64(at) ^ self._jump(np.uint64(mark), mask))
            else:
                self.stash.append(mark << 40 | at)

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Take out keys that were inserted before."""
        for mark, a, b in zip(*(x.tolist() for x in self._places(h1, h2)), strict=True):
            for at in (a, b):
                found = np.flatnonzero(self.cells[at] == mark)
                if len(found):
                    self.cells[at][found[0]] = 0
                    break
            else:
                self.stash.remove(next(s for s in (mark << 40 | a, mark << 40 | b) if s in self.stash))

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(h1, h2)
        fits = (self.cells[a] == mark[:, None]).any(1) | (self.cells[b] == mark[:, None]).any(1)
        for s in self.stash:
            place = np.uint64(s & ((1 << 40) - 1))
            fits |= (mark == np.uint64(s >> 40)) & ((a == place) | (b == place))
        return fits


def split_lines(text: bytes, min_length: int) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text and their keys; a key that must stay is empty."""
    lines = text.split(b"\n")
    keys = [line.strip().lower() for line in lines]
    if min_length > 1:
        keys = [k if len(k) >= min_length and len(k.decode()) >= min_length else b"" for k in keys]
    return lines, keys


def hashed(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit halves of each key's hash."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(k) for k in keys]), "<i8").reshape(-1, 2)


def line_references(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """h1, h2, refs: in how many documents each key occurs. Counted in the tasks first."""

    def per_batch(batch, _):
        refs: dict[bytes, int] = {}
        for text in utf8(batch.column(0)):
            for key in set(split_lines(text, min_length)[1]):
                refs[key] = refs.get(key, 0) + 1
        refs.pop(b"", None)
        halves = hashed(list(refs))
        yield [halves[:, 0], halves[:, 1], list(refs.values())]

    counted = map_arrow(docs.select(exact(text_col)), per_batch, "h1 long, h2 long, refs long")
    return counted.groupBy("h1", "h2").agg(F.sum("refs").alias("refs"))


def empty_index(spark: SparkSession, min_docs: int = MIN_DOCS, min_length: int = MIN_LENGTH) -> Index:
    counts = spark.createDataFrame([], "h1 long, h2 long, refs long")
    filters = spark.createDataFrame([], "shard int, cells binary, stash array<long>")
    return Index(counts, filters, 1, min_docs, min_length)


def _changed(index: Index, docs: DataFrame, text_col: str, sign: int) -> Index:
    delta = line_references(docs, text_col, index.min_length).withColumn("refs", sign * F.col("refs"))
    before = index.counts.select("h1", "h2", "refs", F.col("refs").alias("old"))
    merged = (
        before.unionByName(delta.withColumn("old", F.lit(0).cast("long")))
        .groupBy("h1", "h2")
        .agg(F.sum("refs").alias("refs"), F.sum("old").alias("old"))
    )
    table = written(merged, "line-counts")
    if sign < 0 and (unknown := table.where("refs < 0").count()):
        raise NotInserted(f"{unknown} lines would have negative counts")
    most = F.col("refs") >= index.min_docs
    least = F.col("old") >= index.min_docs
    frequent = table.where(most).count()
    shards = index.shards
    if frequent > shards * KEYS_PER_SHARD:
        # The filters are full: build them anew over more shards.
        shards = 1 << (2 * frequent // KEYS_PER_SHARD).bit_length()
        old_filters, moves = index.filters.limit(0), table.where(most).withColumn("enters", F.lit(True))
    else:
        old_filters, moves = index.filters, table.where(most != least).withColumn("enters", most)
    shard = _shard(shards)

    def update(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        cuckoo = (
            CuckooFilter(np.frombuffer(old.cells[0], np.uint16).copy(), old.stash[0])
            if len(old)
            else CuckooFilter.sized(KEYS_PER_SHARD)
        )
        gone, new = keys[~keys.enters], keys[keys.enters]
        cuckoo.delete(gone.h1.to_numpy(), gone.h2.to_numpy())
        cuckoo.insert(new.h1.to_numpy(), new.h2.to_numpy())
        number = int(old.shard[0] if len(old) else keys.shard[0])
        return pd.DataFrame(
            {"shard": [number], "cells": [cuckoo.cells.tobytes()], "stash": [cuckoo.stash]}
        )

    filters = (
        old_filters.groupBy("shard")
        .cogroup(moves.select(shard, "h1", "h2", "enters").groupBy("shard"))
        .applyInPandas(update, "shard int, cells binary, stash array<long>")
    )
    counts = table.where("refs <> 0").select("h1", "h2", "refs")
    return index._replace(counts=counts, filters=written(filters, "line-filters"), shards=shards)


def insert(index: Index, docs: DataFrame, text_col: str = "text") -> Index:
    """The index with ``docs`` added."""
    return _changed(index, docs, text_col, 1)


def delete(index: Index, docs: DataFrame, text_col: str = "text") -> Index:
    """The index without ``docs``, which must have been inserted; see :class:`NotInserted`."""
    return _changed(index, docs, text_col, -1)


def _shard(shards: int) -> Column:
    return F.shiftrightunsigned("h1", 44).bitwiseAND(F.lit(shards - 1)).cast("int").alias("shard")


def _lines(docs: DataFrame, min_length: int) -> DataFrame:
    """doc_id, mark, place, h1, h2 of every line that may have to go."""

    def per_batch(batch, _):
        ids, texts, marks = batch.column(0), utf8(batch.column(1)), batch.column(2)
        split = [split_lines(t, min_length)[1] for t in texts]
        halves = hashed([k for keys in split for k in keys])
        counted = np.array([len(keys) for keys in split], np.int64)
        owner = np.repeat(np.arange(len(split)), counted)
        place = ragged(np.zeros(len(split), np.int64), counted)
        keyed = np.fromiter((bool(k) for keys in split for k in keys), bool, len(owner))
        own = pa.array(owner[keyed])
        yield [ids.take(own), marks.take(own), place[keyed], halves[keyed, 0], halves[keyed, 1]]

    return map_arrow(docs, per_batch, "doc_id long, mark long, place long, h1 long, h2 long")


def _passed(lines: DataFrame, index: Index) -> DataFrame:
    """The lines that the filters of their shards let through.

    Each task gets, in order, a filter and the lines to probe it with, the next filter and its
    lines, and so on; it holds one filter at a time.
    """
    salt = F.pmod(F.xxhash64("doc_id", "mark", "place"), F.lit(SALTS)).cast("int").alias("salt")
    no_filter = [F.lit(None).cast("binary").alias("cells"), F.lit(None).cast("array<long>").alias("stash")]
    probing = lines.select(_shard(index.shards), salt, F.lit(1).alias("kind"), "*", *no_filter)
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    no_line = [F.lit(None).cast("long").alias(c) for c in lines.columns]
    probed = index.filters.select("shard", every, F.lit(0).alias("kind"), *no_line, "cells", "stash")
    dealt = probed.unionAll(probing).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def setup():
        return {"at": None, "filter": None}

    def per_batch(batch, state):
        shard, salt, kind = (batch.column(n).to_numpy() for n in range(3))
        h1, h2 = (batch.column(n).fill_null(0).to_numpy() for n in (6, 7))
        hit = np.zeros(len(kind), bool)
        # A new run begins at every filter, and where the shard or salt changes without one.
        change = (kind == 0) | (np.diff(shard, prepend=-1) != 0) | (np.diff(salt, prepend=-1) != 0)
        bounds = [0, *np.flatnonzero(change).tolist(), len(kind)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            if kind[a] == 0:
                cells = np.frombuffer(batch.column(8)[a].as_py(), np.uint16)
                state["at"], state["filter"] = (shard[a], salt[a]), CuckooFilter(cells, batch.column(9)[a].as_py())
                a += 1
            # Lines of a shard without a filter have no frequent key.
            if a < b and state["at"] == (shard[a], salt[a]):
                hit[a:b] = state["filter"].contains(h1[a:b], h2[a:b])
        places = pa.array(np.flatnonzero(hit))
        yield [batch.column(n).take(places) for n in range(3, 8)]

    return map_arrow(dealt, per_batch, "doc_id long, mark long, place long, h1 long, h2 long", setup)


def drop_lines(
    docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256, text (what is kept)."""
    read = docs.select(
        exact(id_col).cast("long").alias("doc_id"),
        exact(text_col).alias("text"),
        F.xxhash64(exact(text_col)).alias("mark"),
    )
    frequent = index.counts.where(F.col("refs") >= index.min_docs).select("h1", "h2")
    goes = (
        _passed(_lines(read, index.min_length), index)
        .join(frequent, ["h1", "h2"], "left_semi")
        .groupBy("doc_id", "mark")
        .agg(F.collect_set("place").alias("goes"))  # equal rows have the same places
    )
    goes = written(goes, "lines-to-drop").select(F.col("doc_id").alias("id"), F.col("mark").alias("of"), "goes")

    def per_batch(batch, _):
        doc_ids, texts = batch.column(0), utf8(batch.column(1))
        gone = batch.column(2).to_pylist()
        n_lines, dropped, digests, kept_texts = [], [], [], []
        for text, places in zip(texts, gone, strict=True):
            lines = text.split(b"\n")
            places = set(places or ())
            kept = b"\n".join([x for n, x in enumerate(lines) if n not in places]) if places else text
            n_lines.append(len(lines))
            dropped.append(len(places))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode())
        yield [doc_ids, n_lines, dropped, digests, kept_texts]

    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of"))
    joined = read.join(goes, same, "left").select("doc_id", "text", "goes")
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, text string"
    return map_arrow(joined, per_batch, schema)


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return drop_lines(docs, insert(empty_index(spark), docs)).drop("text")


SQL = r"""
WITH r AS (SELECT doc_id, text, row_number() OVER () AS row FROM documents),
l AS (
  SELECT doc_id, row, n, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row, unnest(lines) AS line, generate_subscripts(lines, 1) AS n
        FROM (SELECT doc_id, row, string_split(coalesce(text, ''), chr(10)) AS lines FROM r))),
f AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10),
m AS (SELECT l.*, f.key IS NOT NULL AS gone FROM l LEFT JOIN f ON l.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id, row
"""
