"""Rows that every operator must cope with, and plain versions to compare with."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, "
    "row long, score double, token long, size int, key string, bucket int, __digest string, `a.b` int"
)


def vocabulary(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abdefgilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def row(doc_id, text, lang="en", source="s1"):
    n = None if text is None else len(text)
    return (doc_id, text, lang, source, n, "x", 1, 0.5, 2, 3, "k", 4, "y", 5)


def hard_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows."""
    words = vocabulary(300)
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    rows = [
        row(1, None),
        row(2, ""),
        row(3, " \n\t "),
        row(4, "One two"),
        row(5, "ONE two"),
        row(6, "éÉ ÀÇ"),
        row(7, "éé ÀÇ"),
        row(8, base),
        row(9, base + " tail end"),
        row(10, base.upper()),
        row(None, base),
        row(None, "only here " + prose(30), None, None),
        row(11, prose(20_000)),
        row(12, "x" * 70_000),
        row(13, "3 4 5 6 " * 5_000),
        row(14, "日本語 текст 🙂 🙂"),
        row(15, "a\nb\n\nA \n" * 50, "en", ""),
        row(16, "1234 5678", None, None),
    ]
    rows += [rows[7], rows[7]]
    rows += [row(100 + n, prose(40), "en", f"s{n % 4}") for n in range(30)]
    rows += [row(200 + n, base.replace(base.split()[5 + n], "zz"), "en", "s1") for n in range(12)]
    return rows


def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(4)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
