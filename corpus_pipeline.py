"""From raw documents to token ids: five stages, each over all that the one before kept.

``run`` writes every stage's result as Parquet to the shared folder and reads it again for the next one, so a lost
executor repeats tasks of one stage only. The rows of a stage carry whole texts and all columns: workers get them in small
batches. A stage returns before its rows are worked on, so it leaves the session set so; ``run`` sets it back.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import glossaflow
from glossaflow.llm import bpe, decontamination, jaccard_join, language_id, toxicity
from glossaflow.llm.common import held_out, quoted, table
from glossaflow.scratch import scratch_folder, small_batches, stage, take_small_batches

# Python functions travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(glossaflow)


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but the text renamed, so that none is taken for one an operator adds."""
    return docs.select(*[quoted(c).alias(c if c == "text" else f"__given{i}") for i, c in enumerate(docs.columns)])


def _back(kept: DataFrame, names: list[str]) -> DataFrame:
    return kept.select(*[F.col(c if c == "text" else f"__given{i}").alias(c) for i, c in enumerate(names)])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like one of the languages of the corpus; rejected ones go."""
    take_small_batches(spark)
    models = language_id.fit(docs, ~held_out("doc_id", 4, 2))
    return _back(language_id.identify(_aside(docs), models).where("not rejected"), docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    take_small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))
    return _back(toxicity.score(_aside(docs), model).where("predicted = 0"), docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per class of near duplicates: five-word shingles, similarity 0.8 or more."""
    take_small_batches(spark)
    return jaccard_join.one_per_class(docs, words=5, num=8, den=10, scan=True)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    take_small_batches(spark)
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    take_small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("jaccard_join", one_of_each),
    ("decontamination", without_benchmark),
    ("byte_bpe", as_tokens),
]

# Language models, boosted trees and byte-pair merges cannot be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark)
    with small_batches(spark):
        for name, function in STAGES:
            docs = stage(function(spark, docs, sf_dir), name, folder)
    return docs
