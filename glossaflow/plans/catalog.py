"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.functions.text import merge_sentences, split_sentences, strip_newlines
from glossaflow.operators import ordering
from glossaflow.operators.backends import TAG, best_candidates
from glossaflow.operators.batching import FunctionBackend, batched_map
from glossaflow.operators.translate import (
    SENTENCES,
    WHOLE_TEXTS,
    Cutting,
    explode_units,
    translate,
    translate_units,
)
from glossaflow.plans import corpus
from glossaflow.plans.inputs import (
    TARGETS,
    dialogue_pairs,
    documents,
    language_counts,
    lexicon,
    memory,
    memory_candidates,
    requests,
    table,
)
from glossaflow.registry import languages as registry
from glossaflow.scratch import scratch_folder
from glossaflow.sources import sinks, splits
from glossaflow.streaming.requests import REQUEST_SCHEMA, read_answers, stream_requests, translate_requests

LABELS = sinks.RunLabels("documents", "plain", "facebook/nllb-200-3.3B", date(2024, 1, 31))

# A sentence above this length cannot be served by the backend of `poisoned_calls`.
LONGEST_SENTENCE = 400

# ISO-639 rows the audit query checks against: a match by each part, one altered row, a name given twice, the rest left out.
ISO_SAMPLE = {
    "name": ["English", "German", "French", "Cebuano", "Filipino", "Hawaiian", "Hmong", "Spanish", "Spanish"],
    "part1": ["en", "de", "xx", None, None, None, None, "xx", "es"],
    "part2b": ["eng", "ger", "xxx", None, "fil", None, None, "spa", None],
    "part2t": ["eng", "deu", "xxx", None, None, "haw", None, "spa", None],
    "part3": ["eng", "deu", "xxx", "ceb", None, None, None, "spa", None],
    "part5": [None, None, None, None, None, None, "hmn", None, None],
}


def _counted(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add the number of documents whose language has the row's ``code``."""
    return df.join(language_counts(spark, sf_dir), "code", "left").withColumn(
        "n_documents", F.coalesce("n_documents", F.lit(0)).cast("long")
    )


# sources and sinks


def read_splits(spark, sf_dir):
    files = {
        "train": [f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet"],
        "validation": [f"{sf_dir}/conversations.parquet"],
        "test": [],
    }
    return splits.read_splits(spark, files, "parquet", schema="text string")


def select_splits(spark, sf_dir):
    chosen = splits.select_splits(documents(spark, sf_dir), ["train", "validation"])
    return chosen.select("row_id", "split", "source")


def keep_translate_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "row_id")
    return splits.keep_translate_columns(docs, ["text"], carried=["row_id"])


def split_counts(spark, sf_dir):
    return splits.split_counts(documents(spark, sf_dir))


def split_preview(spark, sf_dir):
    return splits.split_preview(documents(spark, sf_dir))


def translated_preview(spark, sf_dir):
    """The first document of each split in every target language."""
    shown = corpus.translated_preview(documents(spark, sf_dir), ["text"], TARGETS, TAG)
    return shown.select("split", "row_id", "source", "target", "text", "status")


def named_table(spark, sf_dir):
    """A catalog table that carries its splits in a column of another name."""
    documents(spark, sf_dir).withColumnRenamed("split", "part").createOrReplaceTempView("named_documents")
    return splits.split_counts(splits.read_named(spark, "named_documents", "part"))


def csv_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = f"{scratch_folder(spark)}/documents.csv"
    sinks.write_csv(docs, path)
    return sinks.read_csv(spark, path, docs.schema)


def jsonl_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    path = f"{scratch_folder(spark)}/documents.jsonl"
    sinks.write_jsonl(docs, path)
    return sinks.read_jsonl(spark, path, docs.schema)


def output_layout(spark, sf_dir):
    """The folders an export into two formats wrote, and the rows their files hold."""
    folder = scratch_folder(spark)
    table_of_record = sinks.label(translate(documents(spark, sf_dir), ["text"], TARGETS, TAG, WHOLE_TEXTS), LABELS)
    paths = sinks.export_splits(table_of_record, f"{folder}/out", ["row_id", "text"])
    written = sinks.written_rows(spark, paths, table_of_record.select("row_id", "text").schema)
    return written.select(F.regexp_extract("path", f"{folder.split('/')[-1]}/(.*)$", 1).alias("path"), "n_rows")


def source_copy(spark, sf_dir):
    return corpus.source_copy(documents(spark, sf_dir))


# registries


def resolve_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    named = registry.codes_to_names(docs, "lang", registry.languages(spark, registry.CLOUD), "language")
    flores = registry.canonical_languages(spark, registry.FLORES)
    return registry.names_to_codes(named, "language", flores, "flores_code").select(
        "doc_id", "lang", "language", "flores_code"
    )


def cloud_code_normalise(spark, sf_dir):
    cloud = registry.languages(spark, registry.CLOUD)
    normalised = registry.normalise_codes(cloud.select("code", "name"), "code", cloud, "canonical")
    return _counted(normalised.select("code", "name", "canonical"), spark, sf_dir)


def target_languages(spark, sf_dir):
    """Documents each target language has to receive (those already in it need none), in both registries."""
    flores = documents(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    cloud = language_counts(spark, sf_dir).select(F.col("code").alias("source"), F.col("n_documents").alias("n"))
    parts = []
    for system, counts in ((registry.FLORES, flores), (registry.CLOUD, cloud)):
        codes = registry.target_codes(system)
        parts.append(
            counts.withColumn("code", F.explode(registry.literal_list(codes)))
            .groupBy("code")
            .agg(F.sum(F.when(F.col("code") != F.col("source"), F.col("n")).otherwise(0)).alias("n_documents"))
            .select(F.lit(system).alias("system"), "code", "n_documents")
        )
    return parts[0].unionByName(parts[1])


def registry_checks(spark, sf_dir):
    both = registry.languages(spark)
    mt5 = registry.mt5_languages(spark).withColumn("system", F.lit("mt5")).select(*both.columns)
    everything = both.unionByName(mt5)
    named = registry.codes_to_names(
        language_counts(spark, sf_dir), "code", registry.languages(spark, registry.CLOUD), "name"
    ).select("name", "n_documents")
    covered = (
        everything.select("system", "name").distinct().join(named, "name")
        .groupBy("system").agg(F.sum("n_documents").alias("n_documents"))
    )
    return registry.registry_checks(everything).join(covered, "system", "left")


def mt5_mapping(spark, sf_dir):
    mapping = registry.mt5_mapping(spark).select("code", "name", F.posexplode("matches").alias("pos", "match"))
    flat = mapping.select(
        "code",
        "name",
        F.col("pos").cast("long").alias("pos"),
        F.col("match.code").alias("flores_code"),
        F.col("match.name").alias("flores_name"),
    )
    return _counted(flat, spark, sf_dir)


def mapping_json(spark, sf_dir):
    """The mapping of the languages the documents are in, as one JSON object."""
    mapping = registry.mt5_mapping(spark).join(language_counts(spark, sf_dir), "code", "left_semi")
    return registry.mapping_json(mapping)


def mt5_unmapped(spark, sf_dir):
    return _counted(registry.mt5_unmapped(spark).select("code", "name"), spark, sf_dir)


def iso_audit(spark, sf_dir):
    iso = registry.small_table(spark, ISO_SAMPLE)
    audited = registry.iso_audit(registry.mt5_languages(spark).select("name", "code"), iso)
    return _counted(audited, spark, sf_dir)


# text


def sentence_split(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("row_id", F.posexplode(split_sentences(F.col("text"))).alias("pos", "sentence")).withColumn(
        "pos", F.col("pos").cast("long")
    )


def sentence_merge(spark, sf_dir):
    return documents(spark, sf_dir).select("row_id", merge_sentences(split_sentences(F.col("text"))).alias("text"))


def sentence_offsets(spark, sf_dir):
    counted = documents(spark, sf_dir).select(
        "split", "row_id", F.size(split_sentences(F.col("text"))).cast("long").alias("n_sentences")
    )
    return ordering.sentence_offsets(counted, ["split"], ["row_id"], "n_sentences")


def strip_newlines_query(spark, sf_dir):
    return documents(spark, sf_dir).select("row_id", strip_newlines(F.col("text")).alias("text"))


# translation


def target_fanout(spark, sf_dir):
    """Distinct sentences and their length per language pair, over every default target."""
    sentences = explode_units(documents(spark, sf_dir), ["text"], SENTENCES).where(F.col("text").isNotNull())
    targets = registry.target_codes(registry.FLORES)
    return (
        sentences.select("source", "text").distinct()
        .select("source", F.length("text").alias("n"), F.explode(registry.literal_list(targets)).alias("target"))
        .where(F.col("target") != F.col("source"))
        .groupBy("source", "target")
        .agg(F.count("*").alias("n_sentences"), F.sum("n").alias("n_chars"))
    )


def translate_all_languages(spark, sf_dir):
    """Every document in every default target language, as a digest of the translated text."""
    targets = registry.target_codes(registry.FLORES)
    translated = translate(documents(spark, sf_dir), ["text"], targets, TAG, copy_own_language=False)
    return translated.select("row_id", "source", "target", "n_units", F.md5("text").alias("digest"))


def translate_sentences(spark, sf_dir):
    return translate(documents(spark, sf_dir), ["text"], TARGETS, memory(spark, sf_dir))


def translate_lexicon(spark, sf_dir):
    return translate(documents(spark, sf_dir), ["text"], TARGETS, lexicon(spark, sf_dir))


def translate_whole(spark, sf_dir):
    return translate(documents(spark, sf_dir), ["text"], TARGETS, TAG, WHOLE_TEXTS)


def multi_key_translate(spark, sf_dir):
    rows = dialogue_pairs(spark, sf_dir)
    return translate(rows, ["inputs", "targets"], TARGETS, TAG, Cutting(sentences=False, drop_newlines=True))


def multi_key_lookup(spark, sf_dir):
    return translate(dialogue_pairs(spark, sf_dir), ["inputs", "targets"], TARGETS, lexicon(spark, sf_dir))


def best_candidate(spark, sf_dir):
    return best_candidates(memory_candidates(spark, sf_dir))


def translate_corpus(spark, sf_dir):
    """Documents into three languages, sentence by sentence, written as one partitioned table with its source copy."""
    run = corpus.translate_corpus(
        documents(spark, sf_dir),
        ["text"],
        LABELS,
        TAG,
        f"{scratch_folder(spark)}/corpus",
        target_codes_wanted=TARGETS,
        splits=["train", "validation"],
    )
    return run.table.select("row_id", *sinks.LAYOUT, "text", "n_units", "status")


def run_metrics(spark, sf_dir):
    rows = corpus.corpus_rows(
        documents(spark, sf_dir), ["text"], TARGETS, memory(spark, sf_dir), splits=["train", "validation"]
    )
    return corpus.run_metrics(sinks.label(rows, LABELS))


# user functions and requests


def _marking():
    return lambda source, target, texts: [f"{source}>{target}: {text}" for text in texts]


def _marking_without_zulu():
    def call(source, target, texts):
        if target == "zul_Latn":
            raise RuntimeError("no model for zul_Latn")
        return [f"{source}>{target}: {text}" for text in texts]

    return call


def _marking_short_texts():
    def call(source, target, texts):
        if any(len(text) > LONGEST_SENTENCE for text in texts):
            raise ValueError("text too long")
        return [f"{source}>{target}: {text}" for text in texts]

    return call


def translate_function(spark, sf_dir):
    return translate(documents(spark, sf_dir), ["text"], TARGETS, FunctionBackend(_marking, batch_rows=1000))


def failed_rows(spark, sf_dir):
    """Answers of a backend that cannot serve one language, by pair and status."""
    units = explode_units(documents(spark, sf_dir), ["text"], SENTENCES).select("source", "text")
    backend = FunctionBackend(_marking_without_zulu, batch_rows=1000, retry_wait=(0.0, 0.0))
    return (
        translate_units(units, TARGETS, backend)
        .groupBy("source", "target", "status", F.col("attempts").cast("long").alias("attempts"), "error")
        .agg(F.count("*").alias("n_sentences"), F.sum("n_rows").alias("n_occurrences"))
    )


def poisoned_calls(spark, sf_dir):
    """Answers of a backend that fails for a whole call if one text in it is too long: only those texts fail."""
    units = explode_units(documents(spark, sf_dir), ["text"], SENTENCES).select("source", "text")
    backend = FunctionBackend(_marking_short_texts, batch_rows=200, max_tries=2, retry_wait=(0.0, 0.0), give_up_after=400)
    return translate_units(units, TARGETS[:1], backend).select(
        "source", "target", F.md5("text").alias("digest"), F.md5("translation").alias("translated"), "status", "error"
    )


def batched_map_query(spark, sf_dir):
    def measure(batch):
        texts = [None if text is None else f"{len(text)}:{text}" for text in batch["text"]]
        return {"row_id": batch["row_id"], "text": texts}

    return batched_map(documents(spark, sf_dir).select("row_id", "text"), measure, batch_size=40)


def batch_plan(spark, sf_dir):
    return ordering.batch_plan(documents(spark, sf_dir), "text", ["split"], ["row_id"])


def _answers(answered: DataFrame) -> DataFrame:
    return answered.select("request_id", F.posexplode("translated_texts").alias("pos", "translation")).withColumn(
        "pos", F.col("pos").cast("long")
    )


def request_batch(spark, sf_dir):
    return _answers(translate_requests(requests(spark, sf_dir), FunctionBackend(_marking, batch_rows=16)))


def request_memory(spark, sf_dir):
    """Requests answered from the memory; most texts of conversations are not in it."""
    answered = translate_requests(requests(spark, sf_dir), memory(spark, sf_dir))
    both = answered.select("request_id", F.posexplode(F.arrays_zip("translated_texts", "statuses")).alias("pos", "a"))
    return both.select(
        "request_id", F.col("pos").cast("long").alias("pos"), F.col("a.translated_texts").alias("translation"),
        F.col("a.statuses").alias("status"),
    )


def request_failures(spark, sf_dir):
    """Outcome of requests by a backend that cannot serve one language."""
    backend = FunctionBackend(_marking_without_zulu, batch_rows=16, retry_wait=(0.0, 0.0))
    answered = translate_requests(requests(spark, sf_dir), backend)
    rows = answered.select(
        "request_id", F.explode(F.arrays_zip("translated_texts", "statuses", "attempts", "errors")).alias("a")
    )
    return rows.groupBy(
        "request_id", F.col("a.statuses").alias("status"), F.col("a.attempts").cast("long").alias("attempts"),
        F.col("a.errors").alias("error"),
    ).agg(F.count("*").alias("n_texts"), F.count("a.translated_texts").alias("n_translated"))


def stream_requests_query(spark, sf_dir):
    folder = scratch_folder(spark)
    incoming = f"{folder}/incoming"
    requests(spark, sf_dir).write.json(incoming)
    stream = spark.readStream.schema(REQUEST_SCHEMA).json(incoming)
    query = stream_requests(
        stream, FunctionBackend(_marking, batch_rows=16), f"{folder}/answers", f"{folder}/progress", {"availableNow": True}
    )
    query.awaitTermination()
    return _answers(read_answers(spark, f"{folder}/answers"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_splits": read_splits,
    "select_splits": select_splits,
    "keep_translate_columns": keep_translate_columns,
    "split_counts": split_counts,
    "split_preview": split_preview,
    "translated_preview": translated_preview,
    "named_table": named_table,
    "csv_roundtrip": csv_roundtrip,
    "jsonl_roundtrip": jsonl_roundtrip,
    "output_layout": output_layout,
    "source_copy": source_copy,
    "resolve_language": resolve_language,
    "cloud_code_normalise": cloud_code_normalise,
    "target_languages": target_languages,
    "registry_checks": registry_checks,
    "mt5_mapping": mt5_mapping,
    "mt5_unmapped": mt5_unmapped,
    "mapping_json": mapping_json,
    "iso_audit": iso_audit,
    "sentence_split": sentence_split,
    "sentence_merge": sentence_merge,
    "sentence_offsets": sentence_offsets,
    "strip_newlines": strip_newlines_query,
    "target_fanout": target_fanout,
    "translate_all_languages": translate_all_languages,
    "translate_sentences": translate_sentences,
    "translate_lexicon": translate_lexicon,
    "translate_whole": translate_whole,
    "translate_function": translate_function,
    "multi_key_translate": multi_key_translate,
    "multi_key_lookup": multi_key_lookup,
    "best_candidate": best_candidate,
    "batch_plan": batch_plan,
    "batched_map": batched_map_query,
    "request_batch": request_batch,
    "request_memory": request_memory,
    "request_failures": request_failures,
    "stream_requests": stream_requests_query,
    "run_metrics": run_metrics,
    "failed_rows": failed_rows,
    "poisoned_calls": poisoned_calls,
    "translate_corpus": translate_corpus,
}
