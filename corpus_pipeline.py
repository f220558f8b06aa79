"""From documents to packed training sequences, in five stages.

Every stage takes (spark, docs, folder) and returns a frame that is written as Parquet
and reread as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmart.llm import exact_dedup, jaccard_join, language, mixing, packing
from trackmart.llm.common import documents, exact, fresh, written

LEAST_CONFIDENCE = 1 / 3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are labelled with some confidence.

    A document's certainty is the mean over words of the largest label probability. It goes
    when that lies less than ``LEAST_CONFIDENCE`` of the way from a blind guess among the
    learned languages to 1, or when it has no letter; one in several languages stays. Where a
    single language was learned, only documents without a letter go; where none was, because
    no document has a label, nothing can be told and all stay. The prediction fills a null
    ``lang`` in. The model learns from the documents' own labels, outside the held-out fold.
    """
    held_out = language.folds(F.col("doc_id"), 5) == 0
    sample = language.training_sample(docs, F.col("text"), F.col("lang"), ~held_out)
    model = language.fit(sample)
    if not (n := len(model.languages)):
        return docs
    lang, certainty = fresh(docs, "lang"), fresh(docs, "certainty")
    found = language.label_rows(docs, model, lang, certainty)
    named = found.where(F.col(certainty) >= (1 + (n - 1) * LEAST_CONFIDENCE) / n).withColumn("lang", F.coalesce("lang", lang))
    return named.select(*map(exact, docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z and a-z, the document with the largest id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word shingle sets at a similarity of 0.8 or more."""
    return jaccard_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of at most 4096 tokens."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language identification", identify_language),
    ("exact dedup", drop_copies),
    ("near-duplicate removal", drop_near_copies),
    ("source mixing", mix_sources),
    ("sequence packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# A stage labels languages with a fitted model, which SQL cannot express; tests compare
# the pipeline with a plain version instead.
ORACLE_SQL = None
