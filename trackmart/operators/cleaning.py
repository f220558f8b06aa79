"""Row-level cleaning. Order matters: dedupe, null drop, sentinel, value filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackmart import schemas as S
from trackmart.functions import (
    complete,
    genre_group,
    popularity_tier,
    round_exact,
    within_limits,
)


def _tie_breakers(df: DataFrame, key: str, tie_breakers: Sequence[str] | None) -> list[str]:
    # All other columns give a total order up to rows that are equal anyway.
    return list(tie_breakers) if tie_breakers else [c for c in df.columns if c != key]


def dedupe(
    df: DataFrame,
    key: str = "track_id",
    tie_breakers: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the first in tie-breaker order, nulls first.

    The rank filter becomes a per-task group limit before the shuffle, so a key
    with very many copies sends one row per map task, not the whole group.

    ``within`` names columns that follow from the key. Rows that a join has dealt out by
    these are ranked where they are, without another shuffle.
    """
    order = [F.col(c).asc_nulls_first() for c in _tie_breakers(df, key, tie_breakers)]
    rank = F.row_number().over(Window.partitionBy(*within, key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def drop_nulls(df: DataFrame, subset: Sequence[str] = tuple(S.NOT_NULL_COLUMNS)) -> DataFrame:
    return df.filter(complete(df, subset))


def fix_sentinel(df: DataFrame, column: str = "key", sentinel: int = S.KEY_UNKNOWN) -> DataFrame:
    """Replace the "unknown" code by null; tables without the column pass through."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.nullif(F.col(column), F.lit(sentinel)))


def outlier_filter(df: DataFrame) -> DataFrame:
    return df.filter(within_limits())


def add_genre_group(df: DataFrame) -> DataFrame:
    return df.withColumn("genre_group", genre_group())


def add_popularity_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("popularity_tier", popularity_tier())


def clean(df: DataFrame, tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """The whole cleaning chain, lazily, with both derived columns."""
    return clean_unique(dedupe(df, tie_breakers=tie_breakers))


def clean_unique(df: DataFrame) -> DataFrame:
    """:func:`clean` for a table with one row per track."""
    kept = outlier_filter(fix_sentinel(drop_nulls(df)))
    return kept.withColumns(
        {"genre_group": genre_group(), "popularity_tier": popularity_tier()}
    )


def serving_projection(df: DataFrame) -> DataFrame:
    """The 18 columns of the detail table."""
    return df.select(*S.TRACKS.fieldNames())


def coerce_tracks(df: DataFrame) -> DataFrame:
    """Detail table with null texts emptied and every column in its declared type.

    Numbers that are null stay null; the key checks report them. Fractions are cut off
    towards zero, and what a type cannot hold becomes null.
    """
    columns = []
    for field in S.TRACKS.fields:
        value = F.col(field.name)
        if field.dataType.simpleString() == "string":
            value = F.coalesce(value.cast("string"), F.lit(""))
        else:
            value = value.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _fate(df: DataFrame):
    """What cleaning does to a row: 0 kept, 1 dropped for a null, 2 for a value."""
    return F.when(~complete(df, S.NOT_NULL_COLUMNS), 1).when(within_limits(), 0).otherwise(2)


def survivors(df: DataFrame, tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """One row per track with its ``fate``: what audit and cleaned table are both made of."""
    kept = dedupe(df, tie_breakers=tie_breakers)
    return kept.withColumn("fate", _fate(kept))


def cleaned_survivors(kept: DataFrame) -> DataFrame:
    """:func:`clean` for rows whose fate is known."""
    rows = fix_sentinel(kept.filter("fate = 0").drop("fate"))
    return rows.withColumns({"genre_group": genre_group(), "popularity_tier": popularity_tier()})


def audit_survivors(kept: DataFrame, raw_rows: int) -> DataFrame:
    """:func:`cleaning_audit` for rows whose fate is known."""
    counted = kept.agg(
        F.lit(raw_rows).cast("bigint").alias("raw_rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("fate") == 1).alias("nulls_removed"),
        F.count_if(F.col("fate") == 2).alias("outliers_removed"),
        F.count_if(F.col("fate") == 0).alias("clean_rows"),
    )
    return _removals(counted)


def cleaning_audit(
    df: DataFrame, key: str = "track_id", tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """Rows removed at each cleaning step, in one row.

    Per key only the copy count and the surviving row's fate travel through the
    shuffle, combined map-side; no step is counted by a job of its own.
    """
    order = F.struct(*[F.col(c) for c in _tie_breakers(df, key, tie_breakers)])
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"), F.min_by(_fate(df), order).alias("fate")
    )
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("fate") == 1).alias("nulls_removed"),
        F.count_if(F.col("fate") == 2).alias("outliers_removed"),
        F.count_if(F.col("fate") == 0).alias("clean_rows"),
    )
    return _removals(totals)


def _removals(totals: DataFrame) -> DataFrame:
    return totals.select(
        "raw_rows",
        (F.col("raw_rows") - F.col("keys")).alias("duplicates_removed"),
        "nulls_removed",
        "outliers_removed",
        "clean_rows",
        (F.col("raw_rows") - F.col("clean_rows")).alias("removed_total"),
        round_exact(F.try_divide(F.col("clean_rows") * 100, F.col("raw_rows")), 2).alias(
            "retention_pct"
        ),
    )
