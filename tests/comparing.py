"""Run a registered query and its SQL statement, and compare the full results."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    return value + 0.0 if isinstance(value, float) else value  # -0.0 becomes 0.0


def differences(query, statement: str, spark, folder: str) -> str | None:
    frame = query(spark, folder)
    result = connect(folder).execute(statement)
    names = [d[0] for d in result.description]
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    ours, theirs = bag(frame.columns, frame.collect()), bag(names, result.fetchall())
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    if not extra and not missing:
        return None
    return (
        f"columns {sorted(names)}; rows {sum(ours.values())} vs {sum(theirs.values())}; "
        f"{len(extra)} only in Spark, e.g. {sorted(map(str, extra))[:2]}; "
        f"{len(missing)} only in SQL, e.g. {sorted(map(str, missing))[:2]}"
    )
