"""Column expressions shared by the operators. All built-in, all code-generated."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart import schemas as S

_FIELD_SEP = "\x1f"
_NULL_MARK = "\x1e"


def round_exact(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, returned as double.

    Going through a decimal first keeps half-way cases independent of the last
    bits of a floating-point average. NaN becomes null.
    """
    return F.round(value.try_cast("decimal(28,9)"), digits).cast("double")


def avg_rounded(column: str, digits: int | None) -> Column:
    """``avg(column)``, optionally rounded by :func:`round_exact`."""
    mean = F.avg(column)
    return mean if digits is None else round_exact(mean, digits)


def genre_group(genre: str = "genre") -> Column:
    """Genre family: the first matching case-sensitive substring rule wins."""
    text = F.col(genre)
    (needle, label), *rest = S.GENRE_RULES
    chain = F.when(text.contains(needle), label)
    for needle, label in rest:
        chain = chain.when(text.contains(needle), label)
    return chain.otherwise(S.GENRE_OTHER)


def popularity_tier(popularity: str = "popularity") -> Column:
    score = F.col(popularity)
    low, mid, high = S.TIERS
    return F.when(score <= S.TIER_LOW_MAX, low).when(score <= S.TIER_MID_MAX, mid).otherwise(high)


def complete(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where all columns hold a value; NaN counts as missing.

    Spelled as plain null tests, which the Parquet reader can apply.
    """
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    tests = [F.col(c).isNotNull() for c in columns]
    tests += [~F.isnan(c) for c in columns if c in floats]
    return functools.reduce(Column.__and__, tests)


def within_limits() -> Column:
    """True where a row passes the value filter; null where an input is null."""
    low, high = S.POPULARITY_RANGE
    return (
        (F.col("duration_ms") > S.MIN_DURATION_MS)
        & (F.col("tempo") > 0)
        & (F.col("loudness") < 0)
        & F.col("popularity").between(low, high)
    )


def lookup(mapping: Mapping[str, object], key: Column, default: object) -> Column:
    """Value of a small fixed mapping, with a default for unknown or null keys."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def name_key(name: str = "artist_name") -> Column:
    """Join key for case-insensitive name matching."""
    return F.lower(F.col(name))


def hash_bucket(key: str, buckets: int = 100) -> Column:
    """Stable bucket of a key, the same on every engine and partition layout."""
    prefix = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") % buckets


def row_digest(columns: Sequence[str]) -> Column:
    """The md5 of a row's text form, 32 hex digits."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(_NULL_MARK)) for c in columns]
    return F.md5(F.concat_ws(_FIELD_SEP, *fields))
