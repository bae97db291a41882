"""User functions over batches of rows."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

TranslateFunction = Callable[[str, str, list[str]], list[str]]


@dataclass(frozen=True)
class FunctionBackend:
    """A user's batch function ``(source, target, texts) -> translations``.

    ``load`` is called once per Python worker and returns the function, so a model is loaded once.
    ``parallelism`` bounds the number of concurrent callers (partitions of the calling stage). After ``give_up_after``
    failed calls for parts of a batch and none that succeeded, the whole batch counts as failed.
    """

    load: Callable[[], TranslateFunction]
    name: str = "function"
    batch_rows: int = 40
    batch_bytes: int = 204_800
    max_tries: int = 5
    retry_wait: tuple[float, float] = (2.0, 5.0)
    pause: tuple[float, float] = (0.0, 0.0)
    parallelism: int | None = None
    give_up_after: int = 16
    sleep: Callable[[float], None] = time.sleep


def remote_function(post: Callable[[dict], dict]) -> TranslateFunction:
    """A translate function that sends one JSON body per batch through ``post``."""

    def call(source: str, target: str, texts: list[str]) -> list[str]:
        answer = post({"source_language": source, "target_language": target, "texts": texts})
        return answer["translated_texts"]

    return call


def cut_batches(sizes: Iterable[int], max_rows: int, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Greedy ``(start, end)`` cuts within both limits. An oversized text travels alone, whole."""
    start = used = count = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == max_rows or used + size > max_bytes):
            yield start, i
            start, used = i, 0
        used += size
        count = i + 1
    if count > start:
        yield start, count


def call_with_retry(
    backend: FunctionBackend, function: TranslateFunction, source: str, target: str, texts: list[str],
    tries: int | None = None,
) -> tuple[list[str | None], str, int, str | None]:
    """``(translations, status, attempts, error)`` of one call; stops at the first success."""
    error = None
    tries = tries or backend.max_tries
    for attempt in range(1, tries + 1):
        try:
            answer = list(function(source, target, texts))
        except Exception as problem:
            error = f"{type(problem).__name__}: {problem}"
            if attempt < tries:
                backend.sleep(random.uniform(*backend.retry_wait))
            continue
        if len(answer) != len(texts):
            raise ValueError(f"backend returned {len(answer)} translations for {len(texts)} texts")
        if backend.pause[1] > 0:
            backend.sleep(random.uniform(*backend.pause))
        return answer, "ok", attempt, None
    return [None] * len(texts), "failed", tries, error


def call_in_parts(
    backend: FunctionBackend, function: TranslateFunction, source: str, target: str, texts: list[str]
) -> list[tuple[str | None, str, int, str | None]]:
    """``(translation, status, attempts, error)`` per text; texts that make a call fail do not cost the others.

    A call that fails for good is cut in halves, these again, level by level, until the texts that cause it are alone.
    Parts of several texts get one try, single texts all of them. With b such texts among m this takes at most
    2 b (1 + log2 m) calls. If nothing succeeds in ``give_up_after`` parts, the cause is not in the texts: the rest
    has failed as the whole did. ``attempts`` are those of the call that decided about the text.
    """
    answer, *rest = call_with_retry(backend, function, source, target, texts)
    results = [(t, *rest) for t in answer]
    parts = [(0, len(texts))] if rest[0] == "failed" and len(texts) > 1 else []
    failures, some = 0, False
    while parts and (some or failures < backend.give_up_after):
        start, end = parts.pop(0)
        middle = (start + end) // 2
        for low, high in ((start, middle), (middle, end)):
            tries = backend.max_tries if high - low == 1 else 1
            answer, *rest = call_with_retry(backend, function, source, target, texts[low:high], tries)
            if rest[0] == "ok":
                some = True
                results[low:high] = [(t, *rest) for t in answer]
            else:
                failures += 1
                if high - low == 1:
                    results[low:high] = [(None, *rest)]
                else:
                    parts.append((low, high))
    return results


_RESULT = [
    StructField("translation", StringType()),
    StructField("status", StringType()),
    StructField("attempts", IntegerType()),
    StructField("error", StringType()),
]


def callers(df: DataFrame, backend: FunctionBackend) -> int:
    """Number of partitions to call the backend from."""
    return backend.parallelism or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def deal_by_pair(df: DataFrame, backend: FunctionBackend, spread: Column) -> DataFrame:
    """Partition ``(source, target, ...)`` rows by language pair, salted with ``spread``.

    A popular pair, or a text that occurs very often, is shared by many tasks.
    """
    parts = callers(df, backend)
    return df.repartition(parts, "source", "target", F.pmod(spread, F.lit(parts)))


class _Pending:
    """Rows of one language pair that wait until a call is full."""

    def __init__(self):
        self.rows: list[tuple[pa.RecordBatch, int]] = []
        self.texts: list[str] = []
        self.size = 0


def _gathered(rows: list[tuple[pa.RecordBatch, int]]) -> list[pa.Array]:
    """The columns of rows that lie in several record batches."""
    runs: list[tuple[pa.RecordBatch, list[int]]] = []
    for batch, i in rows:
        if not runs or runs[-1][0] is not batch:
            runs.append((batch, []))
        runs[-1][1].append(i)
    parts = [batch.take(pa.array(places)) for batch, places in runs]
    return [pa.concat_arrays([p.column(c) for p in parts]) for c in range(parts[0].num_columns)]


def apply_function(df: DataFrame, backend: FunctionBackend) -> DataFrame:
    """Translate ``(source, target, text, ...)`` rows; adds translation, status, attempts and error.

    Rows of a language pair wait, across record batches, until a call is full, so all calls of a task but the last of
    each pair are; nothing is sorted. What waits is less than one call per pair. Rows come out in the order of the calls.
    Null texts are answered with null and not sent.
    """
    schema = StructType([*df.schema.fields, *_RESULT])
    arrow = to_arrow_schema(schema)
    types = [f.type for f in list(arrow)[-len(_RESULT):]]

    def made(rows: list[tuple[pa.RecordBatch, int]], results: list[tuple]) -> pa.RecordBatch:
        added = [pa.array(values, type=t) for values, t in zip(zip(*results), types)]
        return pa.RecordBatch.from_arrays([*_gathered(rows), *added], names=arrow.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        waiting: dict[tuple[str, str], _Pending] = {}

        def called(pair: tuple[str, str]) -> pa.RecordBatch:
            nonlocal function
            function = function or backend.load()
            full = waiting.pop(pair)
            return made(full.rows, call_in_parts(backend, function, *pair, full.texts))

        for batch in batches:
            unsent = []
            for i, (source, target, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("source", "target", "text")))):
                if text is None:
                    unsent.append((batch, i))
                    continue
                size = len(text.encode())
                pair = source, target
                held = waiting.get(pair)
                if held and (len(held.texts) == backend.batch_rows or held.size + size > backend.batch_bytes):
                    yield called(pair)
                held = waiting.setdefault(pair, _Pending())
                held.rows.append((batch, i))
                held.texts.append(text)
                held.size += size
            if unsent:
                yield made(unsent, [(None, "ok", 0, None)] * len(unsent))
            for held in waiting.values():
                # what waits keeps copies of its rows, not the batch they came in
                fresh = [row for row in held.rows if row[0] is batch]
                if fresh:
                    copy = pa.RecordBatch.from_arrays(_gathered(fresh), names=batch.schema.names)
                    held.rows[-len(fresh):] = [(copy, i) for i in range(len(fresh))]
        for pair in list(waiting):
            yield called(pair)

    return df.mapInArrow(run, schema)


class _Waiting:
    """Rows of one language and block of targets that wait until a call is full."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.n = self.size = 0

    def fits(self, size: int, backend: FunctionBackend) -> bool:
        return not self.n or self.n < backend.batch_rows and self.size + size <= backend.batch_bytes


def answer_columns(slot: int) -> dict[str, str]:
    """The columns that hold the answer to the target at ``slot`` of its block, by their names in a row per target."""
    return {field.name: f"__{field.name}{slot}" for field in _RESULT}


def answer_texts(df: DataFrame, blocks: Sequence[Sequence[str]], backend: FunctionBackend) -> DataFrame:
    """Translate ``(source, text, __block, ...)`` rows into all targets of their block other than their own language.

    Adds the :func:`answer_columns` of every slot of a block, so that a text and what comes with it are there once,
    not once per target; slots without a target and the own language are null. Calls are those of :func:`apply_function`:
    rows of a language wait, across record batches, until a call is full, which then goes to one target after the other.
    No text is null.
    """
    slots = range(len(blocks[0]))
    added = [StructField(answer_columns(i)[f.name], f.dataType) for i in slots for f in _RESULT]
    schema = StructType([*df.schema.fields, *added])
    arrow = to_arrow_schema(schema)
    types = [f.type for f in list(arrow)[-len(_RESULT):]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        waiting: dict[tuple[str, int], _Waiting] = {}

        def called(key: tuple[str, int]) -> pa.RecordBatch:
            nonlocal function
            function = function or backend.load()
            source, block = key
            held = waiting.pop(key).rows
            columns = [pa.concat_arrays([part.column(c) for part in held]) for c in range(held[0].num_columns)]
            texts = columns[held[0].schema.get_field_index("text")].to_pylist()
            for i in slots:
                target = blocks[block][i] if i < len(blocks[block]) else source
                if target == source:
                    columns += [pa.nulls(len(texts), t) for t in types]
                else:
                    results = call_in_parts(backend, function, source, target, texts)
                    columns += [pa.array(values, type=t) for values, t in zip(zip(*results), types)]
            return pa.RecordBatch.from_arrays(columns, names=arrow.names)

        for batch in batches:
            sources, of_block = batch.column("source"), batch.column("__block")
            for source in pc.unique(sources).to_pylist():
                of_source = batch.filter(pc.equal(sources, source))
                for block in pc.unique(of_block).to_pylist() if len(blocks) > 1 else [0]:
                    rows = of_source
                    if len(blocks) > 1:
                        rows = of_source.filter(pc.equal(of_source.column("__block"), block))
                    key, start = (source, block), 0
                    for i, size in enumerate(pc.binary_length(rows.column("text")).to_pylist()):
                        held = waiting.setdefault(key, _Waiting())
                        if not held.fits(size, backend):
                            held.rows.append(rows.slice(start, i - start))
                            yield called(key)
                            held, start = waiting.setdefault(key, _Waiting()), i
                        held.n += 1
                        held.size += size
                    if start < rows.num_rows:
                        # what waits is a copy of its rows, not the batch they came in
                        held.rows.append(rows.take(pa.array(range(start, rows.num_rows))))
        for key in list(waiting):
            yield called(key)

    return df.mapInArrow(run, schema)


def batched_map(
    df: DataFrame,
    function: Callable[[dict[str, list]], dict[str, list]],
    schema: StructType | None = None,
    batch_size: int = 1000,
) -> DataFrame:
    """Apply a function over column batches ``{column: values}`` of at most ``batch_size`` rows.

    The function returns columns of ``schema`` (default: the input's). Parallelism is the number of partitions.
    """
    schema = schema or df.schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                columns = function(batch.slice(start, batch_size).to_pydict())
                yield pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in arrow}, schema=arrow)

    return df.mapInArrow(run, schema)
