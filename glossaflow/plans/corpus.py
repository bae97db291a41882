"""One dataset into all target languages: the whole job."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glossaflow.operators.translate import SENTENCES, Backend, Cutting, translate, with_known_source
from glossaflow.registry.languages import FLORES, code_of, codes_of, resolve_sources, system_of, target_codes
from glossaflow.sources.sinks import RunLabels, export_splits, label, write_canonical
from glossaflow.sources.splits import keep_translate_columns, select_splits, split_preview


@dataclass(frozen=True)
class CorpusRun:
    """Where a run wrote its table, and what it counted while writing.

    ``split_seconds`` are the times from a split's first translated row to its last one, by the clocks of the tasks.
    All splits are written by one job, so these times overlap; none exceeds ``seconds``.
    """

    table: DataFrame
    path: str
    seconds: float
    totals: dict[str, int]
    split_seconds: dict[str, float]
    exported: list[str] = field(default_factory=list)

    def record(self) -> DataFrame:
        """The run as one row ``(path, seconds, n_rows, n_units, n_missed, n_failed)``, to append to a log table."""
        row = {"path": self.path, "seconds": self.seconds, **self.totals}
        return self.table.sparkSession.createDataFrame([row])


def source_copy(df: DataFrame) -> DataFrame:
    """The untranslated rows, labelled as a translation into their own language."""
    return df.withColumns(
        {
            "target": F.col("source"),
            "n_units": F.lit(0).cast("long"),
            "n_missed": F.lit(0).cast("long"),
            "status": F.lit("copied"),
        }
    )


def corpus_rows(
    data: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    backend: Backend,
    splits: Sequence[str] | None = None,
    cutting: Cutting = SENTENCES,
    **translate_options,
) -> DataFrame:
    """Translations of the requested splits and the source copy of every split, in one DataFrame."""
    data = with_known_source(data)
    chosen = data if splits is None else select_splits(data, splits)
    translated = translate(chosen, keys, targets, backend, cutting, copy_own_language=False, **translate_options)
    even = translate_options.get("rebalance")
    # without it every scan task would write a small file per language and split
    copied = data if even is None else data.hint("rebalance", "source", *even)
    return translated.unionByName(source_copy(copied))


def translate_corpus(
    data: DataFrame,
    keys: Sequence[str],
    labels: RunLabels,
    backend: Backend,
    output: str,
    *,
    source_language: str | None = None,
    source_name_column: str | None = None,
    target_codes_wanted: Sequence[str] | None = None,
    target_names_wanted: Sequence[str] | None = None,
    exclude_languages: Iterable[str] = ("English",),
    splits: Sequence[str] | None = None,
    cutting: Cutting = SENTENCES,
    export_root: str | None = None,
    export_formats: Sequence[str] = ("csv", "json"),
    store: str | None = None,
) -> CorpusRun:
    """Translate ``data`` into every wanted language and write one partitioned table.

    ``data`` holds ``row_id``, ``split`` and the string columns ``keys``; ``source_language`` names its
    language unless a ``source`` column gives a code, or ``source_name_column`` a name, per row. Targets are given by
    code, by name, or are the default ones. All languages and splits run in one job. Codes and names are checked before
    the first job starts, names in a column by a job of their own.
    """
    started = time.monotonic()
    spark = data.sparkSession
    system = system_of(labels.checkpoint)
    if source_language is not None:
        data = data.withColumn("source", F.lit(code_of(source_language, system)))
    elif source_name_column is not None:
        data = resolve_sources(data, source_name_column, system)
    elif "source" not in data.columns:
        raise ValueError("name the source language or give a source column")
    if target_names_wanted is not None:
        target_codes_wanted = [*(target_codes_wanted or ()), *codes_of(target_names_wanted, system)]
    targets = target_codes(system, target_codes_wanted, exclude_languages)
    narrow = keep_translate_columns(data, keys)
    rows = corpus_rows(
        narrow, keys, targets, backend, splits, cutting, rebalance=["split"], store=store
    )
    counts, clocks = Observation("corpus"), Observation("clocks")
    names = [r["split"] for r in narrow.select("split").distinct().collect()]
    clock = F.java_method(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("long")
    spans = [
        (F.max(F.when(here, F.col("__at"))) - F.min(F.when(here, F.col("__at")))).alias(f"span{i}")
        for i, here in enumerate(F.col("split").eqNullSafe(F.lit(name)) for name in names)
    ]
    timed = rows.withColumn("__at", clock)
    timed = (timed.observe(clocks, *spans) if spans else timed).drop("__at")
    observed = timed.observe(
        counts,
        F.count("*").alias("n_rows"),
        F.sum("n_units").alias("n_units"),
        F.sum("n_missed").alias("n_missed"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
    labelled = label(observed, labels)
    write_canonical(labelled, output)
    table = read_run(spark, output, labels, labelled.schema)
    exported = export_splits(table, export_root, keys, export_formats) if export_root else []
    took = clocks.get if spans else {}
    seconds = {name: (took[f"span{i}"] or 0) / 1000 for i, name in enumerate(names)}
    return CorpusRun(table, output, time.monotonic() - started, counts.get, seconds, exported)


def translated_preview(
    data: DataFrame, keys: Sequence[str], targets: Sequence[str], backend: Backend, cutting: Cutting = SENTENCES
) -> DataFrame:
    """The first row of each split, translated. The rows are picked first; no other row reaches the backend."""
    return translate(split_preview(data), keys, targets, backend, cutting)


def translate_text(
    spark: SparkSession, text: str, source_language: str, target_language: str, backend: Backend,
    system: str = FLORES, cutting: Cutting = SENTENCES,
) -> str | None:
    """One text from one named language into another."""
    source, target = codes_of([source_language, target_language], system)
    one = spark.createDataFrame([(0, source, text)], "row_id long, source string, text string")
    return translate(one, ["text"], [target], backend, cutting).first()["text"]


def read_run(spark: SparkSession, output: str, labels: RunLabels, schema: StructType) -> DataFrame:
    """The rows one run wrote. The schema keeps partition values as the strings they were."""
    table = spark.read.schema(schema).parquet(output)
    for name, value in labels.columns().items():
        if name != "pair":
            table = table.where(F.col(name) == value)
    return table


def run_metrics(table: DataFrame) -> DataFrame:
    """Rows, units, misses and failures per language pair and split; reads the counters only."""
    return table.groupBy("pair", "split").agg(
        F.count("*").alias("n_rows"),
        F.sum("n_units").alias("n_units"),
        F.sum("n_missed").alias("n_missed"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
