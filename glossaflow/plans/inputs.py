"""The given tables in the shapes the queries start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.operators.backends import LexiconBackend, MemoryBackend
from glossaflow.operators.translate import SENTENCES, explode_units
from glossaflow.registry.languages import (
    CLOUD,
    FLORES,
    canonical_languages,
    codes_to_names,
    languages,
    literal_list,
    names_to_codes,
)

TARGETS = ["arz_Arab", "fra_Latn", "zul_Latn"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Deal a scan out to all cores if it has fewer partitions than that (a table in one row group)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _split_of(row_id: str) -> Column:
    place = F.col(row_id) % 10
    return F.when(place == 0, "test").when(place == 1, "validation").otherwise("train")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, split, source, text)``; ``source`` is the Flores code of the document's language."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), _split_of("doc_id").alias("split"), "lang", "text"
    )
    named = codes_to_names(spread_rows(docs, "row_id"), "lang", languages(spark, CLOUD), "language")
    coded = names_to_codes(named, "language", canonical_languages(spark, FLORES), "source")
    return coded.select("row_id", "split", "source", "text")


def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(code, n_documents)`` by the language code the documents carry."""
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("code")).agg(
        F.count("*").alias("n_documents")
    )


def dialogue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, source, inputs, targets)``: each turn and the assistant turn right after it.

    A turn without an answer has null ``targets``, an answer without a turn before it null ``inputs``; no turn is
    left out. ``row_id`` is ``conversation:turn``.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") != "assistant").select("conv_id", "turn", F.col("text").alias("inputs"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("targets")
    )
    return asked.join(answered, ["conv_id", "turn"], "full").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("row_id"),
        F.lit("eng_Latn").alias("source"),
        "inputs",
        "targets",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per conversation, in mixed language pairs."""
    grouped = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    )
    target = F.get(literal_list(TARGETS), (F.col("conv_id") % len(TARGETS)).cast("int"))
    return grouped.select(
        F.col("conv_id").alias("request_id"),
        F.lit("eng_Latn").alias("source_language"),
        target.alias("target_language"),
        F.transform("turns", lambda t: t["text"]).alias("texts"),
    )


def memory_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scored candidates per target for every sentence of a labelled document."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"))
    known = explode_units(documents(spark, sf_dir).join(labelled, "row_id", "left_semi"), ["text"], SENTENCES)
    sentences = known.where(F.col("text").isNotNull()).select("source", "text").distinct()
    marked = F.concat(F.lit("["), "target", F.lit("] "), "text")
    candidate = F.array(
        F.struct(marked.alias("translation"), F.lit(0.9).alias("score")),
        F.struct(F.concat(F.lit("~"), "text").alias("translation"), F.lit(0.5).alias("score")),
    )
    return (
        sentences.withColumn("target", F.explode(literal_list(TARGETS)))
        .withColumn("__candidate", F.explode(candidate))
        .select("source", "target", "text", "__candidate.translation", "__candidate.score")
    )


def memory(spark: SparkSession, sf_dir: str) -> MemoryBackend:
    return MemoryBackend(memory_candidates(spark, sf_dir))


def lexicon(spark: SparkSession, sf_dir: str) -> LexiconBackend:
    """Every lower-case word of the benchmark texts, spelled backwards."""
    words = (
        table(spark, sf_dir, "benchmark")
        .select(F.explode(F.split(F.lower("text"), "[ \n]+")).alias("text"))
        .where(F.col("text") != "")
        .distinct()
    )
    sources = literal_list(["eng_Latn", "deu_Latn", "fra_Latn", "spa_Latn"])
    return LexiconBackend(
        words.withColumn("source", F.explode(sources))
        .withColumn("target", F.explode(literal_list(TARGETS)))
        .select("source", "target", "text", F.reverse("text").alias("translation"))
    )
