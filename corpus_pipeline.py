"""The corpus pipeline: toxicity, quality, near copies, mixing, packing, in this order.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last return the
columns of ``docs``.  Labels come from ``{sf_dir}/labels.parquet``.  ``run`` applies the stages to the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import cotraining, mixing_pfair, ngram_jaccard, packing, toxicity
from textloom.llm.common import stored, table
from textloom.llm.queries import source_weight

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is one half or more."""
    return cotraining.keep_good(docs, cotraining.learn(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return ngram_jaccard.keep_one_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted in the order of the Pfair schedule of their sources."""
    return mixing_pfair.mixed(docs, mixing_pfair.weights_by_rule(docs, source_weight()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

# learned scores and token packing have no SQL form; tests compare the stages with plain versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, "corpus-stage")
    return docs
