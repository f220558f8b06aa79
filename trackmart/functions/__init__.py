from trackmart.functions.exprs import (
    avg_rounded,
    complete,
    genre_group,
    hash_bucket,
    lookup,
    name_key,
    popularity_tier,
    round_exact,
    row_digest,
    within_limits,
)

__all__ = [
    "avg_rounded",
    "complete",
    "genre_group",
    "hash_bucket",
    "lookup",
    "name_key",
    "popularity_tier",
    "round_exact",
    "row_digest",
    "within_limits",
]
