"""Substring search over names through a posting table of trigrams.

``postings`` has a row for each trigram of each distinct name, and is stored by shard of the
trigram. A pattern's literal runs name the trigrams that every match has; only their shards
are read, names that have all of them are candidates, and the pattern itself decides. Runs
of less than three characters name no trigram: a pattern without a longer one is matched
against all names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.functions import name_key
from trackmart.operators.artists import name_matches, ranked_by_popularity

SHARDS = 256
NAME = "artist_key"


def trigrams_of(name: Column) -> Column:
    """The distinct runs of three characters of a name."""
    starts = F.sequence(F.lit(1), F.char_length(name) - 2)
    runs = F.transform(starts, lambda n: F.substr(name, n, F.lit(3)))
    return F.when(F.char_length(name) >= 3, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def shard_of(trigram: Column) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(SHARDS)).cast("int")


def postings(stats: DataFrame) -> DataFrame:
    """trigram, artist_key and shard for every distinct lower-cased name of ``stats``."""
    names = stats.where(F.col("artist_name").isNotNull()).select(name_key().alias(NAME)).distinct()
    rows = names.select(NAME, F.explode(trigrams_of(F.col(NAME))).alias("trigram"))
    return rows.withColumn("shard", shard_of(F.col("trigram")))


def write_postings(stats: DataFrame, path: str) -> None:
    """Postings in one folder per shard, names of a trigram together."""
    rows = postings(stats).hint("rebalance", "shard")
    rows.sortWithinPartitions("shard", "trigram").write.mode("overwrite").partitionBy("shard").parquet(path)


def literal_runs(term: str, literal: bool = False) -> list[str]:
    """The parts of a search term that a match contains as they stand."""
    if literal:
        return [term]
    parts, run = [], ""
    # A backslash makes the next character literal; the last one, before nothing, is no part.
    for escaped, plain in re.findall(r"\\(.)|([^\\])", term, re.DOTALL):
        if escaped or plain not in "%_":
            run += escaped or plain
        else:
            parts, run = [*parts, run], ""
    return [p for p in (*parts, run) if p]


def needed_trigrams(term: str, literal: bool = False) -> list[str]:
    runs = literal_runs(term.lower(), literal)
    return sorted({run[n : n + 3] for run in runs for n in range(len(run) - 2)})


def candidates(stored: DataFrame, trigrams: list[str]) -> DataFrame:
    """The names that have all ``trigrams``: artist_key. Only their shards are read.

    Names are counted map-side; a trigram is listed once for a name.
    """
    spark = stored.sparkSession
    wanted = spark.createDataFrame([(t,) for t in trigrams], "trigram string")
    shards = sorted({r[0] for r in wanted.select(shard_of(F.col("trigram"))).collect()})
    listed = stored.where(F.col("shard").isin(shards) & F.col("trigram").isin(trigrams))
    return listed.groupBy(NAME).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(trigrams)).select(NAME)


def indexed_search(
    stats: DataFrame, stored: DataFrame, term: str, k: int = 10, literal: bool = False
) -> DataFrame:
    """The same rows as ``artists.artist_search``, through the postings of ``stats``."""
    trigrams = needed_trigrams(term, literal)
    matching = stats.where(name_matches(term, literal))
    if trigrams:
        keyed = matching.withColumn(NAME, name_key())
        matching = keyed.join(candidates(stored, trigrams), NAME, "left_semi").select(stats.columns)
    return ranked_by_popularity(matching, k)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"trigram string, {NAME} string, shard int").parquet(path)
