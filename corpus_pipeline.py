"""From raw documents to token sequences, by five stages of the training-text operators.

Every stage takes all that the one before kept, reads whole texts, and returns the columns of documents; the
last returns one row of token digests for each document that is left. A stage's own parameters are the
operators' defaults: near-duplicates share four fifths of their five-word shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm import decontaminate, language, minhash, suffixes
from tripforge.llm.queries import language_model, table, token_digests
from tripforge.llm.ship import ship
from tripforge.staging import stage

#: The stages are learned, iterative or bytewise; no SQL states them all. Tests hold the whole
#: against plain versions of the stages.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fill in null languages and drop the documents in which the model finds none."""
    ship(spark)
    return language.keep_identified(docs, language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out what an earlier document, or an earlier place, has too."""
    ship(spark)
    cut = suffixes.drop_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold benchmark passages."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of what is left."""
    ship(spark)
    return token_digests(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeated_passages),
    ("benchmark", drop_benchmark),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
