"""Best-fit packing of token sequences, in bulk-synchronous supersteps.

Documents are tokenised and cut where they are read. Pieces are ranked by (length,
place) across all tasks: a piece knows its place among those of its length in its
task, and per-task counts turn that into a global rank, which is what range-sorting
them would give.

A superstep takes all pieces of one length, the longest first. Its sweep gives them
the successor gaps, the smallest that fit; pieces that want the same gap are told
apart by rank, the first ones getting it and the others moving on to the next larger
gap; then gaps are updated, and the next length follows. Pieces of one length are
interchangeable and so are equal gaps, so a sweep is a merge of two short sorted run
lists (lengths are integers up to the capacity): it makes a table of rank intervals,
at most a few for each run, and every piece finds its place by a join with that table.
The outcome is that of best-fit decreasing done one piece at a time.

Rules
-----
* Null text counts as empty; an empty document is the end id alone.
* Only documents longer than the capacity are cut; each cut piece but the last is full.
* Ties in length go by rank, that is by place in the input; repeated rows are packed
  as often as they occur; an empty table gives an empty result. Other columns are not
  read and may have any name.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import (
    documents,
    exact,
    map_arrow,
    portions,
    ragged,
    utf8,
    written,
)

CAPACITY = 4096
END_ID = 1
PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
)


# Texts that need no Unicode normalisation: white space, printable ASCII, Latin-1 letters.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
# How the tokenizer splits lower-cased text, over the characters of PLAIN.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+")
SPECIAL = "<|"  # begins every special token
ODD = "\0"  # marks a word that the whole tokenizer has to encode; no plain text has it


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones
    stand for themselves, the others take code points from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordIds:
    """Token ids of texts, piece by piece.

    The tokenizer's normaliser and splitter never look across white space, so the ids of
    a text are those of its words. Plain text is split as the tokenizer would, and its
    pieces, far fewer than the distinct words, go straight to the tokenizer's model; any
    other word goes through the whole tokenizer. What was encoded is kept, up to a limit.
    """

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # The model's own cache is of no use beside ``rows``, and its 4 MB are not freed with it:
        # a worker would keep as much of every task.
        self.model._resize_cache(0)
        self.letters = byte_letters()
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # row n's ids end at ends[n + 1]

    def split(self, text: str) -> list[str]:
        """The pieces of a text; a word that is not plain is one piece, marked as odd."""
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return PIECE.findall(text.lower())
        pieces = []
        for word in text.encode().split():  # at ASCII white space only
            word = word.decode()
            if PLAIN.fullmatch(word) and SPECIAL not in word:
                pieces += PIECE.findall(word.lower())
            else:
                pieces.append(ODD + word)
        return pieces

    def _encode(self, piece: str) -> list[int]:
        if piece[0] == ODD:
            return self.tokenizer.encode(piece[1:], add_special_tokens=False).ids
        text = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(text)]

    def _learn(self, pieces: list[str]) -> None:
        """Encode the pieces that are not known yet, all at once."""
        known = len(self.rows)
        new = [p for p in dict.fromkeys(pieces) if p not in self.rows]
        if not new:
            return
        found = [self._encode(p) for p in new]
        self.rows.update(zip(new, range(known, known + len(new))))
        ends = self.ends[known] + np.cumsum([len(ids) for ids in found])
        while known + len(new) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.ends[known] : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32)
        self.ends[known + 1 : known + 1 + len(new)] = ends

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.rows) > self.limit:
            self.clear()
        split = [self.split(text.decode()) for text in texts]
        pieces = list(chain.from_iterable(split))
        if not pieces:
            return [np.zeros(0, np.uint32) for _ in texts]
        self._learn(pieces)
        rows = np.fromiter(map(self.rows.__getitem__, pieces), np.int64, len(pieces))
        first, lengths = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        ids = self.flat[ragged(first, lengths)]
        places = np.concatenate([[0], np.cumsum(lengths)])
        bounds = places[np.concatenate([[0], np.cumsum([len(p) for p in split])])]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece; ``nth`` is its place among those of its length in task ``part``."""

    def setup():
        return WordIds(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()

    def per_batch(batch, state):
        encode, seen, part = state
        texts = utf8(batch.column(1))
        for a, b in portions(texts, 1 << 20):
            ids = [np.append(own, np.uint32(END_ID)).astype("<u4") for own in encode(texts[a:b])]
            totals = np.array([len(own) for own in ids], np.int64)
            cut = -(-totals // capacity)
            piece = ragged(np.zeros(len(ids), np.int64), cut)
            lengths = np.minimum(np.repeat(totals, cut) - piece * capacity, capacity)
            nth = np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                of = lengths == length
                nth[of] = seen[length] + np.arange(of.sum())
                seen[length] += of.sum()
            crcs = [zlib.crc32(own[x : x + capacity]) for own in ids for x in range(0, len(own), capacity)]
            doc_ids = batch.column(0).slice(a, b - a).take(pa.array(np.repeat(np.arange(b - a), cut)))
            yield [doc_ids, piece, piece * capacity, lengths, crcs, np.full(len(piece), part), nth]

    return map_arrow(docs, per_batch, PIECES, setup)


def sweeps(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Rank intervals and where their pieces go: (length, low, high, sequence, each, offset).

    Pieces of ``length`` with rank in [low, high) fill sequences from ``sequence`` on,
    ``each`` to a sequence, from ``offset`` on. Gap runs are (gap, first sequence,
    number of sequences), sorted; all sequences of a run are alike.
    """
    plan, gaps, sequences = [], [], 0
    for length in sorted(counts, reverse=True):
        rank, left, updated = 0, counts[length], []
        at = bisect_left(gaps, (length,))
        taken = at
        while left and taken < len(gaps):
            gap, first, n = gaps[taken]
            taken += 1
            rank, left, runs = _fill(plan, length, rank, left, gap, first, n, capacity)
            updated += runs
        if left:
            n = -(-left // (capacity // length))
            rank, left, runs = _fill(plan, length, rank, left, capacity, sequences, n, capacity)
            sequences += n
            updated += runs
        gaps = sorted(gaps[:at] + gaps[taken:] + [g for g in updated if g[0]])
    return plan


def _fill(plan, length, rank, left, gap, first, n, capacity):
    """Give the next pieces to a run of gaps; what is left, and the runs that come of it."""
    each = gap // length
    full = min(n, left // each)
    runs = []
    if full:
        plan.append((length, rank, rank + full * each, first, each, capacity - gap))
        runs.append((gap - each * length, first, full))
        rank, left = rank + full * each, left - full * each
    rest = n - full
    if rest and left:
        plan.append((length, rank, rank + left, first + full, left, capacity - gap))
        runs.append((gap - left * length, first + full, 1))
        rank, left, full, rest = rank + left, 0, full + 1, rest - 1
    if rest:
        runs.append((gap, first + full, rest))
    return rank, left, runs


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    read = docs.select(exact(id_col).cast("long").alias("doc_id"), exact(text_col).alias("text"))
    pieces = written(tokenised_pieces(read, path, capacity), "pieces")

    per_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    # At most one row per possible length.
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    columns = ["length", "low", "high", "sequence", "each", "offset"]
    plan = spark.createDataFrame(
        pd.DataFrame(sweeps(histogram, capacity), columns=columns, dtype="int64"),
        ", ".join(f"{c} long" for c in columns),
    ).withColumnRenamed("length", "fits")
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    placed = ranked.join(
        plan, (F.col("length") == F.col("fits")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    )
    within = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset") + within % F.col("each") * F.col("length")).alias("offset"),
    )


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))
