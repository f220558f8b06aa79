"""Graded quality by ordinal cumulative-link regression.

A document has one linear score s, a mean of hashed token weights plus weights of binned
text statistics, shared by all grades; ordered thresholds t_1 < t_2 < ... cut it into
grades: P(grade >= k) = 1 / (1 + exp(t_k - s)). The expected grade is the sum of these
probabilities, and the tail probability of a wanted grade selects documents.

Ratings come from the label table: 0 for low quality, 1 for good quality that is toxic,
2 for good quality that is not.

Fitting uses at most ``SAMPLE_ROWS`` rated rows, picked by a hash of the id; scoring
reads whole texts. Thresholds are kept ordered by learning the first and the
logarithms of the steps.

Rules
-----
* Null or empty text has statistics only. Rows with a null id or rating are not learned
  from. A grade that the sample lacks gets a threshold all the same; with no rated row
  every document gets the untrained score, and is kept.
* Rows are independent, so repeated rows agree; an empty table gives an empty result.
  Other columns are not read and may have any name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm.common import Table, documents, exact, folds, labels, map_arrow, portions, utf8

SAMPLE_ROWS = 10_000
BUCKETS = 1 << 15
GRADES = 3
WANTED, LEAST_TAIL = 1, 0.5
STEPS, RATE, PENALTY = 200, 0.2, 1e-5
STATISTICS = 8
BINS = 10


@dataclass
class Model:
    words: np.ndarray  # weight of each token bucket
    bins: np.ndarray  # STATISTICS x (BINS + 1)
    thresholds: np.ndarray


def token_shape(token: str) -> str:
    """Kinds of characters in order, runs as one: ``Stupid!!`` gives ``Aa!``."""
    kinds = []
    for c in token:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not kinds or kinds[-1] != kind:
            kinds.append(kind)
    return "".join(kinds[:12])


def token_buckets(token: bytes) -> tuple[int, int]:
    """Buckets of the lower-cased token and of its shape."""
    text = token.decode()
    word = zlib.crc32(b"w" + text.lower().encode()) % BUCKETS
    return word, zlib.crc32(b"s" + token_shape(text).encode()) % BUCKETS


def token_facts(token: bytes) -> tuple[float, ...]:
    """What the statistics sum over tokens: letters, capitals, digits, signs, length."""
    text = token.decode()
    letters = sum(c.isalpha() for c in text)
    digits = sum(c.isdigit() for c in text)
    return letters, sum(c.isupper() for c in text), digits, len(text) - letters - digits, len(text)


def statistics(rows: np.ndarray, facts: np.ndarray) -> np.ndarray:
    """Shares of capitals, digits, signs, repeats and distinct tokens, and lengths, in [0, 1]."""
    n = len(rows)
    if not n:
        return np.zeros(STATISTICS)
    letters, capitals, digits, signs, length = facts[rows].sum(0)
    return np.array(
        [
            min(1.0, np.log2(1 + n) / 16),
            capitals / max(1, letters),
            digits / length,
            signs / length,
            np.mean(rows[1:] == rows[:-1]) if n > 1 else 0.0,
            len(np.unique(rows)) / n,
            min(1.0, length / n / 20),
            letters / length,
        ]
    )


def _table() -> Table:
    return Table(lambda w: (*token_buckets(w), *token_facts(w)), 7)


def _described(texts: list[bytes], table: Table):
    """Token rows and binned statistics of each text."""
    table.trim()
    for text in texts:
        rows = table.indices(text.split())
        bins = (statistics(rows, table.rows[:, 2:]) * BINS).astype(int)
        yield rows, bins


def sample_of(docs: DataFrame, marks: DataFrame, allowed: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` rated documents: text, grade. The chosen ids are broadcast."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    chosen = (
        marks.where(allowed & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .select("doc_id", grade.alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "grade")


def fit(sample: DataFrame, grades: int = GRADES) -> Model:
    """Maximum likelihood by gradient steps with per-weight rates.

    Workers send each sampled document as token buckets with frequencies.
    """

    def describe(batch, table):
        texts, marks = utf8(batch.column(0)), batch.column(1).to_pylist()
        for a, b in portions(texts):
            out = [[], [], [], marks[a:b]]
            for rows, bins in _described(texts[a:b], table):
                buckets, n = np.unique(table.rows[rows, :2].astype(np.int64), return_counts=True)
                out[0].append(buckets.tolist())
                out[1].append((n / max(1, len(rows))).tolist())
                out[2].append(bins.tolist())
            yield out

    schema = "buckets array<int>, shares array<float>, bins array<int>, grade int"
    rows = map_arrow(sample, describe, schema, _table).toArrow()
    model = Model(np.zeros(BUCKETS), np.zeros((STATISTICS, BINS + 1)), np.arange(1.0, grades) - grades / 2)
    n = rows.num_rows
    if not n:
        return Model(model.words, model.bins, np.full(grades - 1, -1.0) + np.arange(grades - 1) * 1e-3)
    lists = rows.column("buckets").combine_chunks()
    owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten().to_numpy()
    share = rows.column("shares").combine_chunks().flatten().to_numpy().astype(float)
    bins = rows.column("bins").combine_chunks().flatten().to_numpy().reshape(n, STATISTICS)
    bins = bins + np.arange(STATISTICS) * (BINS + 1)
    grade = rows.column("grade").to_numpy()
    words, binned = model.words, np.zeros(STATISTICS * (BINS + 1))
    base, gaps = -1.0, np.zeros(grades - 2)
    rates = [np.full(words.shape, 1e-10), np.full(binned.shape, 1e-8), np.full(grades - 1, 1e-8)]
    for _ in range(STEPS):
        thresholds = base + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        s = np.bincount(owner, words[flat] * share, n) + binned[bins].sum(1)
        tail = 1 / (1 + np.exp(np.clip(thresholds[None] - s[:, None], -30, 30)))
        tails = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], 1)
        chance = np.maximum(tails[np.arange(n), grade] - tails[np.arange(n), grade + 1], 1e-9)
        slopes = np.concatenate([np.zeros((n, 1)), tail * (1 - tail), np.zeros((n, 1))], 1)
        upper, lower = slopes[np.arange(n), grade], slopes[np.arange(n), grade + 1]
        by_score = (upper - lower) / chance / n
        by_threshold = np.zeros(grades + 1)
        np.add.at(by_threshold, grade, -upper / chance / n)
        np.add.at(by_threshold, grade + 1, lower / chance / n)
        by_threshold = by_threshold[1:-1]
        for weights, slope, rate in (
            (words, np.bincount(flat, by_score[owner] * share, BUCKETS) - PENALTY * words, rates[0]),
            (binned, np.bincount(bins.ravel(), np.repeat(by_score, STATISTICS), len(binned)) - PENALTY * binned, rates[1]),
        ):
            rate += slope**2
            weights += RATE * slope / np.sqrt(rate)
        after = np.array([by_threshold.sum(), *(np.exp(gaps) * by_threshold[::-1].cumsum()[::-1][1:])])
        rates[2] += after**2
        move = RATE * after / np.sqrt(rates[2])
        base, gaps = base + move[0], gaps + move[1:]
    thresholds = base + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    return Model(words, binned.reshape(STATISTICS, BINS + 1), thresholds)


def grade_documents(
    docs: DataFrame, model: Model, wanted: int = WANTED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail (probability of ``wanted`` or more)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(batch, table):
        model = sent.value
        ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
        expected, tails = [], []
        for a, b in portions(texts):
            for rows, bins in _described(texts[a:b], table):
                s = model.bins[np.arange(STATISTICS), bins].sum()
                if len(rows):
                    s += model.words[table.rows[rows, :2].astype(np.int64)].sum() / len(rows)
                chances = 1 / (1 + np.exp(np.clip(model.thresholds - s, -30, 30)))
                expected.append(float(chances.sum()))
                tails.append(float(chances[wanted - 1]))
        yield [ids, expected, tails]

    read = docs.select(exact(id_col).cast("long").alias("doc_id"), exact(text_col).alias("text"))
    return map_arrow(read, per_batch, "doc_id long, expected_grade double, tail double", _table)


def op4_quality_grade(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = folds(F.col("doc_id"), 3) == 1
    model = fit(sample_of(docs, labels(spark, folder), ~held_out))
    graded = grade_documents(docs, model)
    return graded.select(
        "doc_id",
        held_out.alias("held_out"),
        F.round("expected_grade", 6).alias("expected_grade"),
        F.round("tail", 6).alias("tail"),
        (F.col("tail") >= LEAST_TAIL).alias("kept"),
    )
