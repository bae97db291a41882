"""Translation requests: many language pairs in one batch, one answer list per request."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glossaflow.operators.backends import MemoryBackend, NativeBackend, best_candidates
from glossaflow.operators.batching import FunctionBackend, apply_function, deal_by_pair
from glossaflow.operators.skew import hashed, hot_keys, lookup_join
from glossaflow.operators.translate import UNDETERMINED, with_known_source
from glossaflow.registry.languages import CLOUD_LANGUAGES, FLORES, FLORES_LANGUAGES, literal_list
from glossaflow.scratch import file_system, path_exists, stage

ANSWER_SCHEMA = (
    "request_id bigint, translated_texts array<string>, statuses array<string>, attempts array<int>, errors array<string>"
)
REQUEST_SCHEMA = "request_id bigint, source_language string, target_language string, texts array<string>"


def request_texts(requests: DataFrame) -> DataFrame:
    """One row per text of a request; a request without texts keeps one row."""
    return requests.select(
        "request_id",
        F.col("source_language").alias("source"),
        F.col("target_language").alias("target"),
        F.posexplode_outer("texts").alias("pos", "text"),
    )


def reduced_memory(backend: MemoryBackend) -> MemoryBackend:
    """The memory with the best translation of each text only, written once: for many small batches."""
    best = stage(best_candidates(backend.table), "memory")
    return replace(backend, table=best)


def _taker(field: str):
    return lambda answer: answer[field]


def _status_list(value: str) -> Column:
    size = F.size("texts")
    return F.when(size >= 0, F.array_repeat(F.lit(value), F.greatest(size, F.lit(0))))


def unknown_code(system: str) -> Column:
    """What is wrong with the codes of a request; null if nothing is."""
    known = literal_list([code for code, _ in (FLORES_LANGUAGES if system == FLORES else CLOUD_LANGUAGES)])
    wrong = [
        F.when(~F.array_contains(known, F.coalesce(c, F.lit(""))) & ~F.col(c).eqNullSafe(F.lit(spared)), F.coalesce(c, F.lit("null")))
        for c, spared in (("source_language", UNDETERMINED), ("target_language", ""))
    ]
    listed = F.concat_ws(", ", *wrong)
    return F.when(listed != "", F.concat(F.lit(f"unknown {system} language codes: "), listed))


def translate_requests(
    requests: DataFrame, backend: NativeBackend | MemoryBackend | FunctionBackend, hot: Sequence[int] | None = None,
    system: str | None = FLORES,
) -> DataFrame:
    """Answer ``(request_id, source_language, target_language, texts)`` with ``(request_id, translated_texts,
    statuses, attempts, errors)``.

    All four lists have the length and order of the request's list. A status is ``ok``, ``failed`` (no
    translation), ``miss`` (not in the memory) or ``copied`` (the text already is in the target language; it is
    not sent). A function sees each distinct text of a pair once. ``hot`` holds hashes of keys to spread in a
    memory lookup; by default a sketch finds them. All texts of a request whose codes the registry ``system`` does
    not hold are ``failed``, with the codes in the error, and not sent; None allows any code.
    """
    requests = with_known_source(requests, "source_language")
    if system is not None:
        checked = requests.withColumn("__wrong", unknown_code(system))
        answered = translate_requests(checked.where("__wrong is null").drop("__wrong"), backend, hot, None)
        refused = checked.where("__wrong is not null").select(
            "request_id",
            F.transform("texts", lambda t: F.lit(None).cast("string")).alias("translated_texts"),
            _status_list("failed").alias("statuses"),
            F.transform("texts", lambda t: F.lit(0)).alias("attempts"),
            F.transform("texts", lambda t: F.col("__wrong")).alias("errors"),
        )
        return answered.unionByName(refused)
    own = F.col("source_language").eqNullSafe(F.col("target_language"))
    if isinstance(backend, NativeBackend):
        made = F.transform("texts", lambda t: backend.column(t, F.col("source_language"), F.col("target_language")))
        return requests.select(
            "request_id",
            F.when(own, F.col("texts")).otherwise(made).alias("translated_texts"),
            F.when(own, _status_list("copied")).otherwise(_status_list("ok")).alias("statuses"),
            F.transform("texts", lambda t: F.lit(0)).alias("attempts"),
            F.transform("texts", lambda t: F.lit(None).cast("string")).alias("errors"),
        )
    texts = request_texts(requests)
    spread = F.xxhash64("request_id", "pos")
    key = ["source", "target", "text"]
    foreign = ~F.col("source").eqNullSafe(F.col("target"))
    if isinstance(backend, FunctionBackend):
        sent = texts.where(foreign & F.col("text").isNotNull()).select(*key).distinct()
        answers = stage(apply_function(deal_by_pair(sent, backend, F.xxhash64("text")), backend), "answers")
        found = lookup_join(texts, hashed(answers, key), key, spread, hot or ())
        translation = F.when(foreign, F.col("translation")).otherwise(F.col("text"))
        status = F.when(~foreign, "copied").otherwise(F.coalesce("status", F.lit("ok")))
        attempts, error = F.coalesce("attempts", F.lit(0)), F.col("error")
    else:
        hot = hot_keys(requests, request_texts, key) if hot is None else hot
        found = lookup_join(texts, hashed(best_candidates(backend.table), key), key, spread, hot)
        known = F.col("translation").isNotNull() | F.col("text").isNull()
        kept = F.coalesce("translation", "text") if backend.keep_missing else F.col("translation")
        translation = F.when(foreign, kept).otherwise(F.col("text"))
        missed = "miss" if backend.keep_missing else "failed"
        status = F.when(~foreign, "copied").when(known, "ok").otherwise(missed)
        attempts, error = F.lit(0), F.lit(None).cast("string")
    answer = F.struct("pos", translation.alias("translation"), status.alias("status"), attempts.alias("attempts"),
                      error.alias("error"))
    lists = found.groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), answer))).alias("answers")
    )
    names = {"translation": "translated_texts", "status": "statuses", "attempts": "attempts", "error": "errors"}
    return lists.select(
        "request_id", *[F.transform("answers", _taker(field)).alias(n) for field, n in names.items()]
    )


@dataclass(frozen=True)
class PublishedMemory:
    """A memory that can change while a stream uses it: reduced tables in numbered folders below ``path``."""

    path: str
    keep_missing: bool = True

    def publish(self, backend: MemoryBackend) -> int:
        """Write a memory as the newest version, and return its number; micro-batches that start later use it."""
        spark = backend.table.sparkSession
        version = (self.newest(spark) or 0) + 1
        best_candidates(backend.table).write.mode("overwrite").parquet(self.folder(version))
        return version

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def newest(self, spark: SparkSession) -> int | None:
        """The last version whose write was finished."""
        if not path_exists(spark, self.path):
            return None
        system, top = file_system(spark, self.path)
        names = [status.getPath().getName() for status in system.listStatus(top)]
        numbers = sorted((int(n.split("=")[1]) for n in names if n.startswith("version=")), reverse=True)
        return next((n for n in numbers if path_exists(spark, f"{self.folder(n)}/_SUCCESS")), None)

    def at(self, spark: SparkSession, version: int) -> MemoryBackend:
        return MemoryBackend(spark.read.parquet(self.folder(version)), keep_missing=self.keep_missing)


LEDGER_SCHEMA = "n_requests bigint, memory_version int"


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a query gets with its checkpoint and keeps as long as that exists."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_requests(
    requests: DataFrame,
    backend: NativeBackend | MemoryBackend | FunctionBackend | PublishedMemory,
    output: str,
    checkpoint: str,
    trigger: dict | None = None,
    system: str | None = FLORES,
) -> StreamingQuery:
    """Answer a stream of requests; each micro-batch takes all that wait.

    A micro-batch is written in overwrite mode to a folder of its own, named by the query's id and the batch, so
    a batch that is run again after a failure replaces its first try, and a query whose checkpoint was made anew, even
    at the same path, does not touch earlier answers. A ledger beside the answers lists the batches that
    were begun, with the version of a published memory they use, and those that are finished, which alone are read. A batch
    that is run again uses the version it began with. A plain memory is reduced once, before the stream starts.
    """
    plain = isinstance(backend, MemoryBackend)
    if plain:
        backend = reduced_memory(backend)

    def note(spark: SparkSession, kind: str, place: str, n: int | None, version: int | None) -> None:
        row = spark.createDataFrame([(n, version)], LEDGER_SCHEMA).coalesce(1)
        row.write.mode("overwrite").parquet(f"{output}/_ledger/{kind}/{place}")

    def answer(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = f"run={_query_id(spark, checkpoint)}/batch_id={batch_id}"
        used, version = backend, None
        if isinstance(backend, PublishedMemory):
            begun = f"{output}/_ledger/begun/{place}"
            if path_exists(spark, f"{begun}/_SUCCESS"):
                version = spark.read.schema(LEDGER_SCHEMA).parquet(begun).first()["memory_version"]
            else:
                version = backend.newest(spark)
                if version is None:
                    raise ValueError(f"no memory was published in {backend.path}")
                note(spark, "begun", place, None, version)
            used = backend.at(spark, version)
        hot = () if isinstance(used, MemoryBackend) else None
        counted = Observation()
        answers = translate_requests(batch, used, hot, system).observe(counted, F.count("*").alias("n"))
        answers.write.mode("overwrite").parquet(f"{output}/{place}")
        note(spark, "finished", place, counted.get["n"], version)

    return (
        requests.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
        .start()
    )


def read_ledger(spark: SparkSession, output: str) -> DataFrame:
    """``(run, batch_id, n_requests, memory_version)`` of every finished batch."""
    schema = f"{LEDGER_SCHEMA}, run string, batch_id bigint"
    if not path_exists(spark, f"{output}/_ledger/finished"):
        return spark.createDataFrame([], schema)
    ledger = spark.read.schema(schema).option("basePath", f"{output}/_ledger/finished").parquet(f"{output}/_ledger/finished")
    return ledger.select("run", "batch_id", "n_requests", "memory_version")


def read_answers(spark: SparkSession, output: str) -> DataFrame:
    """The answers of all finished batches."""
    answers = spark.read.schema(f"{ANSWER_SCHEMA}, run string, batch_id bigint").parquet(output)
    finished = read_ledger(spark, output).select("run", "batch_id")
    return answers.join(F.broadcast(finished), ["run", "batch_id"], "left_semi").drop("run", "batch_id")
