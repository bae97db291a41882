"""Joins of many rows against one row per key, with hot keys spread over several tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most this many keys are ever reported hot, so the list has a fixed size bound.
MAX_HOT_KEYS = 1000
# A sketch of this many counters finds every key holding more than 0.1 % of the rows.
_TRACKED = 10_000
# A key is hot from this share of the rows and this many rows on.
MIN_HOT_SHARE = 0.002
MIN_HOT_ROWS = 1_000_000
# Tasks a hot key is dealt over.
COPIES = 64
# Largest table that is broadcast after its size was measured.
BROADCAST_BYTES = 32 * 1024 * 1024


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(
    rows: DataFrame, units_of: Callable[[DataFrame], DataFrame], on: Sequence[str], key: Column | None = None,
    sample: float = 0.02,
) -> list[int]:
    """Hashes of the keys that hold a noticeable share of the units of ``rows``; ``key`` is the hash if it is there.

    A frequent-items sketch over the units of a sample of the rows: tasks send a sketch each, no rows are
    shuffled. The answer only steers where rows go, never which rows a join returns; a key the sample misses
    has a small share and costs a little time at worst.
    """
    units = units_of(rows.sample(sample, seed=1))
    found = units.where(~_any_null(on)).select((key_hash(on) if key is None else key).alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {MAX_HOT_KEYS}, {_TRACKED})").alias("top")
    ).first()
    floor = max(MIN_HOT_ROWS * sample, MIN_HOT_SHARE * found["n"])
    return [entry["item"] for entry in found["top"] or [] if entry["count"] >= floor]


def fits_broadcast(table: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the strings of ``columns`` are few enough to be sent to every executor. Reads the table once."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(32))
    return (table.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES


def hashed(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add the hash of the key as ``__hash``.

    It leads the join keys: rows are then sorted by a number first, which is much faster than by long
    strings that begin alike. The strings stay in the key, so hashes that collide do no harm.
    """
    return df.withColumn("__hash", key_hash(on))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Column,
    hot: Sequence[int] = (),
    also: Sequence[str] = (),
) -> DataFrame:
    """Left join of ``left`` with ``right``, which is :func:`hashed` on ``on`` and holds one row per key.

    The key is ``on`` and ``also``; ``hot`` holds hashes of ``on``. Rows of a hot key are dealt over
    ``COPIES`` salts by ``spread`` and the matching row of ``right`` is repeated for each salt. Rows without
    a ``text`` match nothing; they get ``spread`` for a hash, so that they do not meet in one task. The
    strategy (broadcast or sort-merge) is left to the optimizer.
    """
    keys = ["__hash", *on, *also]
    left = left.withColumn("__hash", F.when(F.col("text").isNull(), spread).otherwise(key_hash(on)))
    return _salted(left, right, keys, spread, hot).drop("__hash")


def id_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Column, hot: Sequence[int] = ()) -> DataFrame:
    """Left join on content ids, the first of ``keys`` being the hash that ``hot`` lists. No key is null."""
    return _salted(left, right, list(keys), spread, hot)


def _salted(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, hot: Sequence[int]) -> DataFrame:
    if hot:
        is_hot = F.col(keys[0]).isin(list(hot))
        every = F.sequence(F.lit(0), F.lit(COPIES - 1))
        left = left.withColumn("__salt", F.when(is_hot, F.pmod(spread, F.lit(COPIES)).cast("int")).otherwise(0))
        right = right.withColumn("__salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
        keys = [*keys, "__salt"]
    return left.join(right, keys, "left").drop("__salt")
