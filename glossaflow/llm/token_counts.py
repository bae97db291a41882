"""Token counts through a digest cache.

A text is known by the digest of its normalised content, a tokenizer by the digest of its model file. Counts are
looked up in the cache table by both; each distinct missing text is encoded once, and its count is appended to
the cache. The normalisation is the one that cannot change a count: null becomes the empty text.

Cache rows are ``(tokenizer, digest, n_tokens)`` as Parquet files. Appends are whole Spark writes; a digest that
two runs append has the same count twice, and is read once. Losing an executor repeats tasks, nothing else.

Results: null and empty texts count 0 tokens (as the library gives for the empty text); repeated rows and equal
texts are all kept and encoded once; added columns replace input columns of their names; an empty table gives an
empty table and appends nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.llm.common import map_batches, without, worker_state
from glossaflow.scratch import scratch_folder, stage

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":  # nothing was written yet
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _library(model: bytes, kind: str):
    if kind == "json":
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model.decode())
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes`` and ``n_tokens``; missing counts are appended to ``cache_path``."""
    spark = docs.sparkSession
    with open(model_path, "rb") as file:
        model = file.read()
    version = hashlib.sha256(model).hexdigest()
    kind = "json" if model_path.endswith(".json") else "model"
    shared = spark.sparkContext.broadcast(model)

    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(content, 256))
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == version)

    # One row per content leaves each task, so copies do not meet in numbers; the cache then drops what it knows.
    rows = docs.select(content.alias("text"), digest.alias("digest"))
    texts = rows.dropDuplicates(["digest"]).join(known.select("digest"), "digest", "left_anti")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = worker_state("tokens", version, lambda: _library(shared.value, kind))
        counts = pa.array(lengths(batch.column("text").to_pylist()), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("digest"), counts], ["digest", "n_tokens"])

    counted = map_batches(texts, encode, "digest binary, n_tokens long")
    if known.isEmpty() or not rows.select("digest").join(known, "digest", "left_anti").isEmpty():
        counted.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path)

    # Written before the join, so that the rows of a frequent text are split over tasks.
    counts = stage(
        read_cache(spark, cache_path).where(F.col("tokenizer") == version)
        .groupBy(F.col("digest").alias("__digest")).agg(F.max("n_tokens").alias("n_tokens")),
        "counts", scratch_folder(spark),
    )
    kept = without(docs, "n_bytes", "n_tokens")
    rows = kept.withColumn("__digest", digest).withColumn("n_bytes", F.octet_length(content).cast("long")).drop(text)
    found = rows.join(counts, "__digest", "left").drop("__digest")
    lost = F.raise_error(F.lit("the cache lost a count that was written")).cast("long")
    return found.withColumn("n_tokens", F.coalesce("n_tokens", lost))
