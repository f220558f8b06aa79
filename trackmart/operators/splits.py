"""Train/test splits and class weights that do not depend on partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import hash_bucket, round_exact

TRAIN, TEST = "train", "test"


def hash_split(df: DataFrame, key: str = "track_id", train_percent: int = 80) -> DataFrame:
    """Add ``split`` from a hash of the key: no shuffle, stable under re-runs."""
    return df.withColumn(
        "split", F.when(hash_bucket(key) < train_percent, TRAIN).otherwise(TEST)
    )


def _cutoffs(
    df: DataFrame, label: str, key: str, fraction: float, classes: Sequence[str], prefix: int
) -> DataFrame:
    """Last key hash that is still training data, one row per class.

    A row trains when the share of its class's other rows that hash lower is
    below ``fraction``. Ranking a whole class would put it in one task, so the
    cutoff is found in two counting passes: a histogram over hash prefixes picks
    the prefix the cutoff lies in, then only that prefix is counted by full hash.
    """
    hashed = df.filter(F.col(label).isin(*classes)).select(
        F.col(label).alias("_label"), _key_hash(key).alias("_hash")
    )
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, prefix))
    per_class = Window.partitionBy("_label")

    def lower(order: str) -> Column:
        frame = per_class.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(frame), F.lit(0))

    def trains(rank: str) -> Column:
        # The lowest hash of a class always trains, as its percent rank is 0.
        return F.coalesce(F.try_divide(rank, F.col("_size") - 1), F.lit(0.0)) < fraction

    histogram = hashed.groupBy("_label", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    placed = histogram.select(
        "_label",
        "_prefix",
        lower("_prefix").alias("_below"),
        F.sum("_n").over(per_class).alias("_size"),
    )
    edge = (
        placed.filter(trains("_below"))
        .groupBy("_label", "_size")
        .agg(F.max("_prefix").alias("_prefix"), F.max("_below").alias("_below"))
    )
    fine = (
        hashed.join(F.broadcast(edge), ["_label", "_prefix"])
        .groupBy("_label", "_hash", "_below", "_size")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = fine.withColumn("_rank", F.col("_below") + lower("_hash"))
    return ranked.filter(trains("_rank")).groupBy("_label").agg(F.max("_hash").alias("_cutoff"))


def first_by_hash(df: DataFrame, rows: int, key: str = "track_id", prefix: int = 4) -> DataFrame:
    """The rows with the lowest key hashes: as many as fit in ``rows``, a key's rows together.

    The same rows whatever the partition layout, and spread as ``df`` is: a histogram over
    hash prefixes finds the prefix in which the bound is reached, then that prefix alone is
    counted by full hash, and the cutoff is a filter. No row is sorted or moved.
    """

    def first_beyond(counted: DataFrame, name: str, before: int) -> tuple[str, int] | None:
        """The first ``name`` with which the count passes the bound, and the count without it."""
        so_far = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = counted.withColumn("_total", F.sum("_n").over(so_far) + before)
        row = totals.where(F.col("_total") > rows).orderBy(name).select(name, F.col("_total") - F.col("_n")).first()
        return row and tuple(row)

    hashed = df.select(_key_hash(key).alias("_hash")).withColumn("_prefix", F.substring("_hash", 1, prefix))
    # At most 16 ** prefix rows, then the distinct hashes of one prefix of them.
    edge = first_beyond(hashed.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n")), "_prefix", 0)
    if edge is None:
        return df
    inside = hashed.where(F.col("_prefix") == edge[0]).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    cutoff, _ = first_beyond(inside, "_hash", edge[1])
    return df.where(_key_hash(key) < cutoff)


def _key_hash(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


def stratified_split(
    df: DataFrame,
    label: str = "popularity_tier",
    key: str = "track_id",
    fraction: float = 0.8,
    classes: Sequence[str] = tuple(S.TIERS),
    prefix: int = 4,
) -> DataFrame:
    """Add ``split`` so that every class is divided in the same proportion.

    Equals ``percent_rank() < fraction`` per class over the key's hash. Rows of
    one key stay together. The cutoff table holds one row for each of ``classes``,
    which bounds what is broadcast; rows of any other label get a null split.
    """
    cutoffs = _cutoffs(df, label, key, fraction, classes, prefix)
    marked = df.join(F.broadcast(cutoffs), F.col(label) == F.col("_label"), "left")
    split = F.when(_key_hash(key) <= F.col("_cutoff"), TRAIN).when(
        F.col("_label").isNotNull(), TEST
    )
    return marked.withColumn("split", split).drop("_label", "_cutoff")


def class_weights(
    df: DataFrame, label: str = "popularity_tier", digits: int | None = 2
) -> DataFrame:
    """Weight of every tier: frequency of the largest class over its own.

    With ``digits`` the published form: rounded, Low pinned to 1, fallbacks for
    classes that do not occur. ``digits=None`` gives the plain unrounded ratio
    over the rows passed in, for classes that occur. Counts are one shuffle-free
    aggregate, so the result has one row per tier whatever the input size.
    """
    counts = df.agg(*[F.count_if(F.col(label) == t).alias(t) for t in S.TIERS])
    largest = F.greatest(*S.TIERS)

    def entry(tier: str):
        ratio = F.try_divide(largest.cast("double"), F.col(tier))
        if digits is None:
            weight = ratio
        elif tier == S.TIERS[0]:
            weight = F.lit(1.0)
        else:
            weight = F.coalesce(round_exact(ratio, digits), F.lit(S.ABSENT_CLASS_WEIGHTS[tier]))
        return F.struct(
            F.lit(tier).alias(label), F.col(tier).alias("class_count"), weight.alias("class_weight")
        )

    rows = counts.select(F.inline(F.array(*[entry(t) for t in S.TIERS])))
    return rows if digits is not None else rows.filter("class_count > 0")


def add_class_weights(
    df: DataFrame, weights: DataFrame, label: str = "popularity_tier"
) -> DataFrame:
    """Attach ``class_weight``, 1 for a label without one.

    :func:`class_weights` yields one row per tier, hence the broadcast.
    """
    joined = df.join(F.broadcast(weights.select(label, "class_weight")), label, "left")
    return joined.na.fill(1.0, ["class_weight"])
