"""From raw documents to training pieces: toxic documents go, then those without a letter or in
another language than the given one, then near copies; what is left is mixed to the sources' weights and cut into pieces.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns the
columns of documents, but for the last. run() writes each result to the shared folder and reads it again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from asset_catalog.llm import langid, mixing, sentencepieces, simhash, toxicity
from asset_catalog.llm.common import stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the machine, fitted on the labelled documents outside the held-out fold, calls toxic."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those whose given language the text clearly contradicts."""
    return langid.drop_unexplained(docs, langid.learn(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that with the smallest id, rows without one last."""
    return simhash.kept_documents(docs, shingle=3, most_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes of each source what its weight asks for: a row for each time a document is taken."""
    return mixing.mixed_documents(docs)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples a segmentation of each row, decodes it, and returns digests of both."""
    return sentencepieces.round_trip(docs, sentencepieces.load())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("language", in_known_language),
    ("near_duplicates", one_of_each),
    ("mix", mixed),
    ("pieces", in_pieces),
]

#: The first stages are models that SQL cannot express; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
