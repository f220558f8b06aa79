"""Reading track tables."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmart import schemas as S


MALFORMED = "_malformed"


def read_tracks_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = S.RAW_TRACKS,
    null_tokens: Iterable[str] = (),
    multiline: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """Raw tracks from CSV files with a header, columns bound by name.

    Only headers are looked at beforehand; types come from ``schema``. Text that
    is no number becomes null, as do NaN and empty fields, and any text listed in
    ``null_tokens``. Columns the file lacks are left out, so that the raw suite can
    report them. Quotes are doubled inside quoted fields. Line breaks inside fields
    need ``multiline``, which makes a file one task: then supply many files.

    All files must have the same header; a file with another one is an error. Rows with
    too many or too few fields are read as far as they go; ``keep_malformed`` adds the
    column ``_malformed`` with their text, null for all other rows.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    header = reader.csv(path).columns
    blank_field = any(re.fullmatch(r"_c\d+", c) for c in header)
    if blank_field:  # Spark compares headers by name, which needs all of them
        _same_header(spark, path)
    fields = [T.StructField(c, T.StringType()) for c in [*header, MALFORMED]]
    raw = (
        reader.schema(T.StructType(fields))
        .options(multiLine=multiline, enforceSchema=blank_field, columnNameOfCorruptRecord=MALFORMED)
        # A row's width is only known where all its fields are parsed.
        .option("columnPruning", not keep_malformed)
        .csv(path)
    )

    tokens = ["", *null_tokens]
    columns = []
    for field in schema.fields:
        if field.name not in header:
            continue
        text = F.col(f"`{field.name}`")
        known = F.when(~text.isin(tokens), text)
        columns.append(_typed(known, field.dataType).alias(field.name))
    extra = [F.col(MALFORMED)] if keep_malformed else []
    return raw.drop(*S.INDEX_COLUMNS).select(*columns, *extra)


def _same_header(spark: SparkSession, path: str) -> None:
    """Raise unless all files begin with the same line. One row per file is compared."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    firsts = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("line"))
    headers = firsts.select("line").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"CSV files with different headers: {[r['line'] for r in headers]}")


def _typed(text, kind: T.DataType):
    if isinstance(kind, T.StringType):
        return text
    number = text.try_cast("double")
    number = F.when(~F.isnan(number), number)
    # Whole numbers may be written with a fraction part, as in "45.0".
    return number.try_cast(kind) if isinstance(kind, T.IntegralType) else number


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number and passes ``> 0``: make it null instead."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def read_tracks_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Cleaned tracks; the partition column comes back as the last column."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
