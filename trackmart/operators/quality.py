"""Data-quality suites, profiles and key checks.

Each suite is one shuffle-free aggregate over the table plus one keyed count for
uniqueness. The two are kept apart on purpose: a distinct count inside the wide
aggregate would drag every other counter through the shuffle, once per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart import schemas as S


class ValidationError(ValueError):
    """Raised by :func:`enforce` when a blocking suite has failed checks."""


def _rows_check_name(min_rows: int) -> str:
    return "row_count_above_1m" if min_rows == 1_000_000 else f"row_count_above_{min_rows}"


def _between(column: str, low: float, high: float) -> Column:
    return F.col(column).between(low, high)


def _suite(df: DataFrame, stage: str, verdicts: Sequence[tuple[int, str, Column]]) -> DataFrame:
    """One aggregate row of booleans, turned into (stage, position, check, passed)."""
    wide = df.agg(*[verdict.alias(name) for _, name, verdict in verdicts])
    rows = F.array(
        *[
            F.struct(
                F.lit(stage).alias("stage"),
                F.lit(position).alias("position"),
                F.lit(name).alias("check"),
                F.coalesce(F.col(name), F.lit(False)).alias("passed"),
            )
            for position, name, _ in verdicts
        ]
    )
    return wide.select(F.inline(rows))


def _unique_check(df: DataFrame, stage: str, position: int, name: str, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return _suite(per_key, stage, [(position, name, F.coalesce(F.max("copies"), F.lit(1)) == 1)])


def _none_fail(condition: Column) -> Column:
    """Every row satisfies the condition; a null counts as a failure."""
    return F.count_if(~F.coalesce(condition, F.lit(False))) == 0


def _known_pass(column: str, condition: Column) -> Column:
    """Every non-null value satisfies the condition, and there is one at all."""
    return (F.count_if(~condition) == 0) & (F.count(column) > 0)


def validate_raw(
    df: DataFrame, min_rows: int = S.MIN_ROWS, duplicates: int | None = None
) -> DataFrame:
    """The 18 advisory checks on raw tracks; null values fail range checks.

    Where the number of repeated ids is known already, say from the cleaning
    audit, passing it saves the keyed count.
    """
    checks: list[tuple[str, str | None, Column | None]] = [
        ("track_id_not_null", "track_id", F.col("track_id").isNotNull()),
        ("track_id_unique", "track_id", None),
        ("artist_name_not_null", "artist_name", F.col("artist_name").isNotNull()),
        ("track_name_not_null", "track_name", F.col("track_name").isNotNull()),
        ("popularity_range_0_100", "popularity", _between("popularity", *S.POPULARITY_RANGE)),
        ("year_range_2000_2023", "year", _between("year", *S.YEAR_RANGE)),
        *[(f"{c}_range_0_1", c, _between(c, 0, 1)) for c in S.UNIT_FEATURES],
        ("tempo_positive", "tempo", F.col("tempo") > 0),
        ("loudness_negative", "loudness", F.col("loudness") < 0),
        ("duration_ms_above_30s", "duration_ms", F.col("duration_ms") > S.MIN_DURATION_MS),
    ]
    complete = all(c in df.columns for c in S.REQUIRED_COLUMNS)
    verdicts = [
        (1, "required_columns_present", F.lit(complete)),
        (2, _rows_check_name(min_rows), F.count(F.lit(1)) >= min_rows),
    ]
    unique = None
    for position, (name, column, condition) in enumerate(checks, start=3):
        if column not in df.columns:
            verdicts.append((position, name, F.lit(False)))
        elif condition is None and duplicates is not None:
            verdicts.append((position, name, F.lit(duplicates == 0)))
        elif condition is None:
            unique = (position, name, column)
        else:
            verdicts.append((position, name, _none_fail(condition)))
    report = _suite(df, "raw", verdicts)
    return report.unionByName(_unique_check(df, "raw", *unique)) if unique else report


def validate_cleaned(df: DataFrame, min_rows: int = S.MIN_ROWS) -> DataFrame:
    """The 16 blocking checks on cleaned tracks; ranges ignore nulls, empty fails.

    A check on a column that the table lacks has failed.
    """
    present = ["track_id", "artist_name", "track_name", "genre", "popularity"]
    ranges = [
        ("popularity_range_0_100", "popularity", _between("popularity", *S.POPULARITY_RANGE)),
        ("year_range_2000_2023", "year", _between("year", *S.YEAR_RANGE)),
        ("danceability_range_0_1", "danceability", _between("danceability", 0, 1)),
        ("energy_range_0_1", "energy", _between("energy", 0, 1)),
        ("tempo_positive", "tempo", F.col("tempo") > 0),
        ("loudness_negative", "loudness", F.col("loudness") < 0),
        ("duration_ms_above_30s", "duration_ms", F.col("duration_ms") > S.MIN_DURATION_MS),
    ]
    derived = [
        ("genre_group_column_present", "genre_group"),
        ("popularity_tier_column_present", "popularity_tier"),
    ]
    named = [
        *[(f"{c}_not_null", c, _none_fail(F.col(c).isNotNull())) for c in present],
        *[(name, c, _known_pass(c, condition)) for name, c, condition in ranges],
        *[(name, c, _none_fail(F.col(c).isNotNull())) for name, c in derived],
    ]
    verdicts = [(1, _rows_check_name(min_rows), F.count(F.lit(1)) >= min_rows)]
    verdicts += [
        (i, name, verdict if c in df.columns else F.lit(False))
        for i, (name, c, verdict) in enumerate(named, start=3)
    ]
    unique = (2, "no_duplicate_track_ids")
    if "track_id" not in df.columns:
        return _suite(df, "cleaned", [*verdicts, (*unique, F.lit(False))])
    return _suite(df, "cleaned", verdicts).unionByName(
        _unique_check(df, "cleaned", *unique, "track_id")
    )


def validation_summary(checks: DataFrame) -> DataFrame:
    """Totals and pass rate per stage. The rate rounds half to even, one decimal."""
    passed, total = F.count_if("passed"), F.count(F.lit(1))
    rate = F.bround((passed * 100 / total).cast("decimal(18,9)"), 1).cast("double")
    return checks.groupBy("stage").agg(
        total.alias("total"),
        passed.alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.format_string("%.1f%%", rate).alias("pass_rate"),
    )


def enforce(checks: DataFrame, strict: bool = True) -> list[str]:
    """Names of failed checks; a strict suite raises on any. Reads report rows only."""
    failed = [r["check"] for r in checks.filter(~F.col("passed")).orderBy("position").collect()]
    if strict and failed:
        raise ValidationError(f"{len(failed)} check(s) failed: {', '.join(failed)}")
    return failed


def column_profile(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls, non-nulls and bounds per column; repeats for the key column.

    Bounds are given for numeric columns. A null key counts as one value.
    """
    names = [c for c in (columns or df.columns) if c != key]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    counters = [F.count(F.lit(1)).alias("_rows")]
    for name in names:
        counters.append(F.count(name).alias(f"_n_{name}"))
        if name in numeric:
            counters.append(F.min(name).cast("double").alias(f"_min_{name}"))
            counters.append(F.max(name).cast("double").alias(f"_max_{name}"))

    def entry(name: str) -> Column:
        known = F.col(f"_n_{name}")
        missing = F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - known).alias("null_count"),
            known.alias("non_null_count"),
            (F.col(f"_min_{name}") if name in numeric else missing).alias("min_value"),
            (F.col(f"_max_{name}") if name in numeric else missing).alias("max_value"),
            F.lit(None).cast("bigint").alias("duplicate_count"),
        )

    wide = df.agg(*counters).select(F.inline(F.array(*[entry(n) for n in names])))
    copies = F.coalesce(F.sum("copies"), F.lit(0))
    nulls = F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("copies"))), F.lit(0))
    keyed = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.lit(key).alias("column_name"),
            copies.alias("row_count"),
            nulls.alias("null_count"),
            (copies - nulls).alias("non_null_count"),
            F.lit(None).cast("double").alias("min_value"),
            F.lit(None).cast("double").alias("max_value"),
            (copies - F.count(F.lit(1))).alias("duplicate_count"),
        )
    )
    return wide.unionByName(keyed)


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values a primary key would reject: repeated or null."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.filter((F.col("row_count") > 1) | F.col(key).isNull())


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per bounded text column: values over the limit and the longest length seen."""
    wide = df.agg(
        *[F.count_if(F.length(c) > n).alias(f"_over_{c}") for c, n in limits.items()],
        *[F.max(F.length(c)).alias(f"_longest_{c}") for c in limits],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(n).alias("max_length"),
            F.col(f"_over_{c}").alias("violations"),
            F.col(f"_longest_{c}").alias("longest"),
        )
        for c, n in limits.items()
    ]
    return wide.select(F.inline(F.array(*entries)))


def conformance(df: DataFrame, key: str, limits: Mapping[str, int]) -> DataFrame:
    """Per constraint of a serving table, how many values break it: (constraint, violations)."""
    lengths = length_violations(df, limits).select(
        F.concat(F.lit("length of "), "column_name").alias("constraint"), "violations"
    )
    keys = key_violations(df, key).agg(
        F.lit(f"key {key}").alias("constraint"), F.count(F.lit(1)).alias("violations")
    )
    return lengths.unionByName(keys)


def schema_mismatches(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences between a frame's columns and a declared table, as messages."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    problems = [f"missing column {c}" for c in wanted if c not in actual]
    problems += [f"unexpected column {c}" for c in actual if c not in wanted]
    problems += [
        f"column {c} is {actual[c].simpleString()}, expected {wanted[c].simpleString()}"
        for c in wanted
        if c in actual and actual[c] != wanted[c]
    ]
    return problems
