"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight, hence a target number of words, and a schedule that tilts
its share over training time: at time t in [0, 1] it is drawn at the rate
``target * (1 + tilt * (1 - 2 t))``. Integrated, a source has been asked for
``target * (t + tilt * t * (1 - t))`` words by time t. Its documents form a stream in
an order fixed by their content, repeated for a second pass where the target asks
for it; inverting the cumulative demand at the middle of a document's words gives
its training position, and the mixed set is range-sorted by position.

The running sum along a source is split in two: sums of hash buckets, then the sum
within a bucket. No task holds a source, however large.

Rules
-----
* The size of a document is its number of words, 0 for null text; empty documents
  are taken nowhere.
* Sources are ordered by code point, null last; weights repeat along that order.
* Targets share ``total_share`` of all sizes, none above ``most_passes`` times its
  source's size; what is cut is shared again by weight among the others.
* ``source_plan`` counts words: the last document of a source is taken in part, so
  that a source meets its target but for a fraction of a word. ``mixed`` takes whole
  documents and rounds to the nearest.
* Repeated rows are separate documents; an empty table gives an empty mix. Columns
  other than id, text and source do not matter and may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import documents, exact, fresh, n_words, written

WEIGHTS = (5, 2, 1)
TILTS = (0.5, 0.0, -0.5)  # early, even, late
TOTAL_SHARE = 1.5
MOST_PASSES = 2
ROWS_PER_BUCKET = 50_000


def order_key(id_column: Column, text: Column) -> Column:
    """Order of a document within its source: 32 hex digits of its content."""
    ident = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.md5(F.concat(ident, F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def targets(
    sizes: DataFrame,
    weights=WEIGHTS,
    tilts=TILTS,
    total_share: float = TOTAL_SHARE,
    most_passes: int = MOST_PASSES,
) -> DataFrame:
    """One row per source: source, source_size, target, tilt.

    Resharing until no target is above its ceiling ends where target = min(ceiling,
    level * weight) for one common level. Sources sorted by ceiling / weight reach
    their ceiling in that order, so the level follows from running sums. ``sizes`` has
    one row per source, which bounds the windows without partition.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_source) - 1) % len(weights) + 1
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ceiling = F.col("source_size") * F.lit(float(most_passes))
    levels = (
        sizes.withColumn("place", place)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place")))
        .withColumn("tilt", F.element_at(F.array(*map(F.lit, tilts)), F.col("place")))
        .withColumn("ceiling", ceiling)
        .withColumn("nth", F.row_number().over(filling))
        .withColumn(
            "level",
            (
                F.sum("source_size").over(everything) * F.lit(total_share)
                - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))
            )
            / F.sum("weight").over(onward),
        )
    )
    # The common level is that of the first source, in filling order, below its ceiling.
    below = F.when(F.col("level") * F.col("weight") < F.col("ceiling"), F.struct("nth", "level"))
    common = F.min(below).over(everything)["level"]
    return levels.select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("ceiling"), common * F.col("weight")), F.col("ceiling")).alias("target"),
        "tilt",
    )


def training_time(share: Column, tilt: Column) -> Column:
    """The time by which a source has been asked for ``share`` of its target words."""
    root = F.sqrt((1 + tilt) * (1 + tilt) - 4 * tilt * share)
    return F.when(tilt == 0, share).otherwise((1 + tilt - root) / (2 * tilt))


def source_offsets(sized: DataFrame, digits: int) -> DataFrame:
    """Words before each (source, bucket) in its source's stream."""
    buckets = sized.groupBy("source", F.substring("key", 1, digits).alias("bucket")).agg(
        F.sum("size").alias("bucket_size")
    )
    before = (
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    return buckets.select(
        "source", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset")
    )


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size, key of every document."""
    return written(
        docs.select(
            exact(id_col).alias("doc_id"),
            exact(source_col).alias("source"),
            n_words(exact(text_col)).alias("size"),
            order_key(exact(id_col), exact(text_col)).alias("key"),
        ),
        "sizes",
    )


def _words(nth: int | Column) -> Column:
    """How many words of a placed document its pass ``nth`` takes."""
    left = F.floor("target") - F.col("source_size") * nth - F.col("start")
    return F.greatest(F.lit(0), F.least("size", left))


def _position(nth: int | Column) -> Column:
    """The training time of a placed document's pass ``nth``."""
    share = (F.col("start") + F.col("source_size") * nth + F.col("size") / 2) / F.col("target")
    return F.round(training_time(F.least(share, F.lit(1.0)), F.col("tilt")), 9)


def source_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **plan,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, position.

    ``position`` is the training time of the first pass, null where nothing is taken;
    :func:`training_order` has all passes. Rows are range-sorted by it.
    """
    placed = _placed(_sizes(docs, id_col, text_col, source_col), **plan)
    passes = [_words(n) for n in range(plan.get("most_passes", MOST_PASSES))]
    taken = sum(passes[1:], passes[0])
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("taken"),
        F.when(taken > 0, _position(0)).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def training_order(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **plan,
) -> DataFrame:
    """One row for each pass over a document that takes words of it: doc_id, pass (from 0), words,
    position; range-sorted by position. Words of a document add up to ``taken``."""
    placed = _placed(_sizes(docs, id_col, text_col, source_col), **plan)
    passes = F.sequence(F.lit(0), F.lit(plan.get("most_passes", MOST_PASSES) - 1))
    nth = F.col("pass")
    return (
        placed.withColumn("pass", F.explode(passes))
        .withColumn("words", _words(nth).cast("long"))
        .where("words > 0")
        .withColumn("position", _position(nth))
        .orderBy("position", "key", "pass")
        .select("doc_id", "pass", "words", "position")
    )


def _placed(sized: DataFrame, **plan) -> DataFrame:
    """Rows with size, key and source, further columns kept, plus the plan of their
    source and ``start``, the words before them in its stream."""
    light = sized.select("source", "size", "key")
    digits = max(2, math.ceil(math.log(max(1, light.count()) / ROWS_PER_BUCKET, 16)))
    sources = targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), **plan)
    places = source_offsets(light, digits).alias("o").join(
        sources.alias("p"), F.expr("o.source <=> p.source")
    )
    bucket = F.substring("key", 1, digits)
    within = (
        Window.partitionBy("source", F.col("bucket"))
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sized.withColumn("bucket", bucket)
        .alias("d")
        .join(
            places.select("o.source", "o.bucket", "offset", "source_size", "target", "tilt").alias("q"),
            F.expr("d.bucket = q.bucket AND d.source <=> q.source"),
        )
        .select("d.*", "q.offset", "q.source_size", "q.target", "q.tilt")
        .withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **plan,
) -> DataFrame:
    """The mixed set: columns of ``docs``, a row for each pass over a document, range-sorted
    by training position. A pass is taken when its middle lies before the target."""
    sized = docs.select(
        exact(id_col).alias("doc_id"),
        exact(source_col).alias("source"),
        n_words(exact(text_col)).alias("size"),
        order_key(exact(id_col), exact(text_col)).alias("key"),
        F.struct(*map(exact, docs.columns)).alias("row"),
    )
    placed = _placed(sized, **plan)
    passes = F.sequence(F.lit(0), F.lit(plan.get("most_passes", MOST_PASSES) - 1))
    middle = F.col("start") + F.col("pass") * F.col("source_size") + F.col("size") / 2
    share = middle / F.col("target")
    return (
        placed.where("size > 0")
        .withColumn("pass", F.explode(passes))
        .where(middle <= F.col("target"))
        .withColumn("position", training_time(share, F.col("tilt")))
        .orderBy("position", "key", "pass")
        .select("row.*")
    )


def op8_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_plan(documents(spark, folder))


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][place] AS weight, [5e-1, 0e0, -5e-1][place] AS tilt,
         source_size * 2e0 AS ceiling
  FROM (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS place FROM s)),
l AS (
  SELECT *, row_number() OVER f AS nth,
         (sum(source_size) OVER ()::BIGINT * 15e-1
          - coalesce(sum(ceiling) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
         / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level
  FROM w WINDOW f AS (ORDER BY source_size / weight, source NULLS LAST)),
t AS (
  SELECT *, coalesce(least(ceiling, common * weight), ceiling) AS target
  FROM (SELECT *, min_by(level, CASE WHEN level * weight < ceiling THEN nth END) OVER () AS common FROM l)),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.tilt, floor(t.target)::BIGINT AS words,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, least((start + size / 2e0) / target, 1e0) AS share,
         greatest(0, least(size, words - start))
         + greatest(0, least(size, words - source_size - start)) AS taken
  FROM p)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE WHEN tilt = 0 THEN share
         ELSE (1 + tilt - sqrt((1 + tilt) * (1 + tilt) - 4 * tilt * share)) / (2 * tilt) END, 9) END AS position
FROM q
"""
