"""Hard negatives by a vertical scan of vectors with branch and bound (BOND).

Rows are dealt to blocks of bounded size, queries to blocks of their own, and each pair of
blocks is one group of a shuffle, so work and memory of a task do not depend on the table's
size. A block holds its vectors by dimension, with the least and greatest value of each.

A query reads a block's dimensions in the order of its own magnitudes, the greatest first,
a few at a time. What the dimensions not yet read can add to a score lies between two sums
of least and greatest contributions, so after every step each candidate's score is bounded
from both sides, and the bitmap of candidates shrinks:

* for positives, to those whose upper bound reaches the fifth greatest lower bound;
* for negatives, to those whose bounds meet the window of some positive, and reach the fifth
  greatest lower bound of the candidates that are certain to lie in that window.

What is left when all dimensions are read has its exact score. The best of each block are
then ranked per query, and per positive.

Rules
-----
* Rows with a null id, label or vector, or with a null or non-finite component, take no part.
* Components are scaled by 256 and rounded down. Beyond 2**28 they are cut to that, so that
  scores fit 64 bits. Vectors of different lengths are compared as if filled up with zeros.
* Ties in score go by the smaller id. A query's own id is never its positive. Repeated rows
  are rows of their own, as queries too. An empty table gives an empty result, and so does a
  query without positives or without negatives in any window.
* Other columns are not read and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import arrow_schema, exact, written

SCALE, LARGEST = 256, 1 << 28
POSITIVES, NEGATIVES = 5, 5
LEAST_PERCENT = 80  # of the positive's score that a negative's has at least
BLOCK, QUERY_BLOCK = 4096, 1024
BLOCKS = 64  # small tables are dealt to so many blocks, for parallelism
STEP = 8  # dimensions read between two prunings


def vectors(rows: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """row (a number of its own), vec_id, label, v (integers) of the rows that take part."""
    vector = exact(vector_col)

    def unusable(x: Column) -> Column:
        # A comparison with NaN would be true: NaN is above all numbers.
        return x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))

    def scaled(x: Column) -> Column:
        bounded = F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
        return F.floor(bounded).cast("int")

    usable = exact(id_col).isNotNull() & label.isNotNull() & vector.isNotNull() & ~F.exists(vector, unusable)
    kept = rows.where(usable).select(
        F.monotonically_increasing_id().alias("row"),
        exact(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(vector, scaled).alias("v"),
    )
    return written(kept, "vectors")  # row numbers are fixed from here on


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy().astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


class Block:
    """Candidates by dimension, with the bounds of each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(v.T)
        self.low, self.high = v.min(axis=0), v.max(axis=0)

    def scan(self, query: np.ndarray, candidates: np.ndarray, may_count) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that ``may_count(lower, upper)`` leaves, and their exact scores."""
        order = np.argsort(-np.abs(query), kind="stable")
        one, other = (query * self.low)[order], (query * self.high)[order]
        least = np.append(np.cumsum(np.minimum(one, other)[::-1])[::-1], 0)
        most = np.append(np.cumsum(np.maximum(one, other)[::-1])[::-1], 0)
        score = np.zeros(len(candidates), np.int64)
        for at in range(0, len(order), STEP):
            for d in order[at : at + STEP]:
                score += query[d] * self.columns[d][candidates]
            done = min(at + STEP, len(order))
            stay = may_count(score + least[done], score + most[done])
            candidates, score = candidates[stay], score[stay]
            if not len(candidates):
                break
        return candidates, score

    def best(self, candidates: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Places of the first ``k`` by falling score, then by id."""
        return np.lexsort((self.ids[candidates], -score))[:k]


def kth_greatest(values: np.ndarray, k: int) -> int | None:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def positives_in(block: Block, query_id: int, label: int, query: np.ndarray, k: int):
    def may_count(lower, upper):
        bar = kth_greatest(lower, k)
        return np.ones(len(upper), bool) if bar is None else upper >= bar

    same = np.flatnonzero((block.labels == label) & (block.ids != query_id))
    found, score = block.scan(query, same, may_count)
    first = block.best(found, score, k)
    return block.ids[found[first]], score[first]


def negatives_in(block: Block, label: int, query: np.ndarray, tops: list[int], percent: int, k: int):
    """Per positive's score in ``tops``: ids and scores of the first ``k`` in its window."""
    windows = [(-(-percent * top // 100), top) for top in tops]

    def may_count(lower, upper):
        stay = np.zeros(len(upper), bool)
        for low, high in windows:
            bar = kth_greatest(lower[(lower >= low) & (upper <= high)], k)
            stay |= (lower <= high) & (upper >= (low if bar is None else max(low, bar)))
        return stay

    found, score = block.scan(query, np.flatnonzero(block.labels != label), may_count)
    for low, high in windows:
        inside = np.flatnonzero((score >= low) & (score <= high))
        first = inside[block.best(found[inside], score[inside], k)]
        yield block.ids[found[first]], score[first]


def block_pairs(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Every row beside every block of queries, and every query beside every block of rows."""
    n, m = rows.count(), queries.count()
    blocks = max(-(-n // BLOCK), min(BLOCKS, -(-n // 64)), 1)
    query_blocks = max(-(-m // QUERY_BLOCK), 1)

    def dealt(frame: DataFrame, own: str, n_own: int, other: str, n_other: int, query: bool) -> DataFrame:
        return frame.select(
            "*",
            F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            F.lit(query).alias("is_query"),
        )

    none = F.array().cast("array<long>")
    asked = dealt(queries, "qb", query_blocks, "rb", blocks, True)
    held = dealt(rows.withColumns({"pos_ids": none, "pos_scores": none}), "rb", blocks, "qb", query_blocks, False)
    return held.unionByName(asked)


FOUND = "row long, anchor_id long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"


def searched(pairs: DataFrame, search) -> DataFrame:
    """``search(block, query)`` in each pair of blocks; ``query`` is a dict, and it yields rows of FOUND."""
    target = arrow_schema(FOUND)

    def run(table: pa.Table) -> pa.Table:
        is_query = np.array(table.column("is_query").to_pylist(), bool)
        out = []
        if is_query.any() and not is_query.all():
            v = table.column("v").combine_chunks()
            width = int(np.diff(v.offsets.to_numpy()).max())
            both = matrix(v, width)
            ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
            block = Block(ids[~is_query], labels[~is_query], both[~is_query])
            asked = table.filter(pa.array(is_query)).drop_columns(["v"]).to_pylist()
            for query, vector in zip(asked, both[is_query], strict=True):
                out.extend(search(block, query, vector))
        return pa.table(list(zip(*out)) if out else [[] for _ in target], schema=target)

    return pairs.groupBy("qb", "rb").applyInArrow(run, FOUND)


def hard_negatives(
    rows: DataFrame,
    is_query: Column,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are those of :func:`vectors`; ``is_query`` tells which are anchors. A negative has
    another label than the anchor and at least ``least_percent`` of the positive's score, but
    no more than all of it.
    """
    none = F.array().cast("array<long>")
    queries = rows.where(is_query)

    def find_positives(block, query, vector):
        ids, scores = positives_in(block, query["vec_id"], query["label"], vector, n_positives)
        for other, score in zip(ids.tolist(), scores.tolist(), strict=True):
            yield query["row"], query["vec_id"], 0, other, score, None, None

    def find_negatives(block, query, vector):
        tops = query["pos_scores"]
        found = negatives_in(block, query["label"], vector, tops, least_percent, n_negatives)
        for nth, (ids, scores) in enumerate(found):
            for other, score in zip(ids.tolist(), scores.tolist(), strict=True):
                yield query["row"], query["vec_id"], nth, query["pos_ids"][nth], tops[nth], other, score

    pairs = block_pairs(rows, queries.withColumns({"pos_ids": none, "pos_scores": none}))
    by_query = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    nearest = (
        searched(pairs, find_positives)
        .withColumn("place", F.row_number().over(by_query))
        .where(F.col("place") <= n_positives)
        .groupBy("row")  # at most n_positives rows each
        .agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("found"))
        .select("row", F.col("found.positive_id").alias("pos_ids"), F.col("found.positive_score").alias("pos_scores"))
    )
    asking = written(queries.join(nearest, "row"), "positives")
    by_positive = Window.partitionBy("row", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return (
        searched(block_pairs(rows, asking), find_negatives)
        .withColumn("rank", F.row_number().over(by_positive))
        .where(F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{folder}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors(embeddings, moved), F.col("vec_id") % 100 == 0)


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * o.v[i]))::BIGINT AS score
  FROM e a JOIN e o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
