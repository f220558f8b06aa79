"""Joins that stay balanced when few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_HOT_KEYS = 10_000


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Sequence[str],
    target_rows: int = 1_000_000,
) -> DataFrame:
    """Left join on ``key`` in which a frequent key is spread over many tasks.

    ``right`` has one row per key. Keys with more than ``target_rows`` left rows are hot;
    each is dealt to as many salts as bring it under the target, by a hash of the
    ``spread`` columns, and its right row is repeated once per salt. The broadcast list
    holds the ``MOST_HOT_KEYS`` hottest keys. Null keys match nothing and are dealt out.
    """
    counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    salts = F.ceil(F.col("_n") / target_rows).cast("int")
    hot = (
        counts.filter(F.col("_n") > target_rows)
        .orderBy(F.desc("_n"), key)
        .limit(MOST_HOT_KEYS)
        .select(key, salts.alias("_salts"))
    )
    mixed = F.xxhash64(*spread)
    salt = F.when(F.col(key).isNull(), F.pmod(mixed, F.lit(1024))).otherwise(
        F.coalesce(F.pmod(mixed, F.col("_salts")), F.lit(0))
    )
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("_salt", salt.cast("int"))
    every = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = right.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(every))
    joined = dealt.drop("_salts").join(repeated.drop("_salts"), [key, "_salt"], "left")
    return joined.drop("_salt")
