"""Exact dedup by splitting off heavy hitters.

A Misra-Gries summary (Spark's ``approx_top_k``, which merges per-task counters of
the frequent-items sketch built on that algorithm) proposes frequent digests. Their
exact counts and winners are then aggregated, with map-side combining, so what the
sketch estimates decides nothing. Frequent groups are resolved where their rows
are, against a broadcast list of at most ``counters`` rows; all other groups, each
of which is small, are shuffled by digest.

Rules
-----
* Texts are equal when identical after lower-casing A-Z; null counts as empty.
* The row with the largest id stays; a null id is below all others.
* Rows that repeat both text and id of the row that stays are that same document:
  ``copy_groups`` marks each as kept, ``exact_dedup`` returns one of them.
* An empty table gives an empty result. Other columns, of any name, are not read
  by ``copy_groups`` and are returned untouched by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackmart.llm.common import documents, exact, fresh, lower_ascii, written

COUNTERS = 1000  # bound of the broadcast list
SKETCH_ITEMS = 8192  # counters each task keeps; a power of two


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def frequent_digests(keyed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests that the summary holds for frequent.

    The sketch guarantees every digest with a share over about 1 / 2000 of the rows;
    those it proposes beyond that are harmless, as they are verified.
    """
    short = F.substring(F.hex("digest"), 1, 15)
    summary = keyed.select(F.conv(short, 16, 10).cast("long").alias("item")).agg(
        F.expr(f"approx_top_k(item, {counters}, {SKETCH_ITEMS})").alias("top")
    )
    return (
        summary.select(F.explode("top").alias("top"))
        .where("top.count >= 100")
        .select(F.col("top.item").alias("item"))
    )


def verified_winners(keyed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact size and surviving id of each frequent digest: at most ``counters`` rows.

    A 60-bit proposal may match several digests; the largest group of each stays.
    """
    items = F.broadcast(frequent_digests(keyed, counters))
    item = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    groups = (
        keyed.withColumn("item", item)
        .join(items, "item", "left_semi")
        .groupBy("digest", "item")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return (
        groups.groupBy("item")
        .agg(F.max_by(F.struct("digest", "keep_id", "group_size"), F.struct("group_size", "digest")).alias("w"))
        .select("w.*")
    )


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed = written(
        docs.select(exact(id_col).alias("doc_id"), text_digest(exact(text_col)).alias("digest")),
        "digests",
    )
    winners = written(verified_winners(keyed), "winners")
    heavy = keyed.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = keyed.join(F.broadcast(winners), "digest", "left_anti").select(
        "digest",
        "doc_id",
        F.max("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
    )
    both = heavy.select(rest.columns).unionAll(rest)
    return both.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Losers of frequent groups are dropped where they are read, before any shuffle.
    """
    digest, keep = fresh(docs, "digest"), fresh(docs, "keep")
    keyed = docs.withColumn(digest, text_digest(exact(text_col)))
    light = written(
        keyed.select(exact(id_col).alias("doc_id"), F.col(digest).alias("digest")), "digests"
    )
    winners = written(verified_winners(light), "winners")
    heavy = F.broadcast(winners.select(F.col("digest").alias(digest), F.col("keep_id").alias(keep)))
    unsettled = keyed.join(heavy, digest, "left").where(
        F.col(keep).isNull() | exact(id_col).eqNullSafe(F.col(keep))
    )
    group = Window.partitionBy(digest).orderBy(exact(id_col).desc_nulls_last())
    rank = fresh(docs, "rank")
    return (
        unsettled.withColumn(rank, F.row_number().over(group))
        .where(F.col(rank) == 1)
        .drop(digest, keep, rank)
    )


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return copy_groups(documents(spark, folder))


SQL = """
WITH d AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
           AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
