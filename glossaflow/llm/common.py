"""Helpers the operators of this subpackage share: reading, Arrow batches in tasks, worker state, checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Text handed to Python code at once; bounds what a task holds besides its longest text.
SLICE_BYTES = 4 << 20
# Sides up to this size are sent to every executor after they were measured; larger ones are shuffled.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the given fold (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds == fold


def worker_state(kind: str, key: object, build: Callable[[], object]) -> object:
    """What ``build`` returned for ``key`` in this Python process; of each kind the last one is held.

    Functions travel by value, so the globals of this package are new in every task; the state hangs on a
    module of the process instead. It only saves time: a new worker builds it again. A process serves one operator
    at a time (the kind up to its first hyphen): the states of the one before are given back first, so what a worker
    holds does not add up over the steps of a job.
    """
    module = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    operator = kind.split("-")[0]
    if getattr(module, "operator", None) != operator:
        module.operator, module.held = operator, {}
        gc.collect()
        give_back_memory()
    if kind not in module.held or module.held[kind][0] != key:
        module.held.pop(kind, None)
        module.held[kind] = key, build()
    return module.held[kind][1]


def give_back_memory() -> None:
    """Return what was freed in this process to the machine, as far as its C library can."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class Sent:
    """An object sent to every executor once, by value: its class need not be installed there."""

    def __init__(self, spark: SparkSession, value: object):
        # named here only: what tasks get of this class must not draw in the whole package
        import glossaflow

        cloudpickle.register_pickle_by_value(glossaflow)
        self._content = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def open(self) -> object:
        return pickle.loads(self._content.value)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds at most ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        place = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str,
                column: str = "text", finish: Callable[[], object] | None = None) -> DataFrame:
    """Apply ``function`` to slices of record batches; a slice without result rows is skipped. ``finish`` is called at
    the end of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, column):
            made = function(part)
            if made is not None and made.num_rows:
                yield made
        if finish:
            finish()
        give_back_memory()

    return df.mapInArrow(run, schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns (in any case) that an operator is about to add: added columns replace old ones."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def small(df: DataFrame, bytes_per_row: int) -> bool:
    """Whether ``df`` is below ``BROADCAST_BYTES``. Counts its rows; ``df`` should be a written table."""
    return df.count() * bytes_per_row <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, bytes_per_row: int) -> DataFrame:
    return F.broadcast(df) if small(df, bytes_per_row) else df
