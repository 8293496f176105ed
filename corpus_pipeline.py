"""A corpus in five stages: known languages, one of each group of near copies, no benchmark
passages, no personal data, and sampled segmentations of what is left.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each stage's result as Parquet to the shared folder and reads it
back, so a lost executor costs at most the stage it was in.

Defined results: rows with a NULL or letterless text are rejected by the first stage; an empty table
stays empty through all stages; rows without key are handled like others; repeated rows are copies,
of which one stays. Extra columns are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.llm import decontamination, language_id, ngram_join, pii, piece_sampling
from forktide.llm.common import stored, table

PIECE_VOCABULARY = "piece_bpe_32k.model"
# The stages use regular expressions, trained models and hashes that DuckDB SQL cannot express; they
# are tested against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from the labelled ones among them."""
    return language_id.accepted(docs, language_id.learn_from(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest key."""
    return ngram_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), by_share=True)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` is counted again."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece sequences of every document."""
    return piece_sampling.segmentations(docs, public_tokenizers.path(PIECE_VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("ngram_join", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("piece_sampling", segmented),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
