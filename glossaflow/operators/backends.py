"""What can stand in for a translation model.

A backend answers rows ``(source, target, text)`` with a translation:

* :class:`NativeBackend` computes it as a column expression,
* :class:`MemoryBackend` looks whole sentences (or texts) up in a table,
* :class:`LexiconBackend` looks words up in a table,
* :class:`~glossaflow.operators.batching.FunctionBackend` calls a user's batch function.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NativeBackend:
    """``column(text, source, target)`` gives the translation.

    ``merged(units, source, target)`` may give the same for an array of units at once, glued with single blanks, where that
    is cheaper than a call per unit.
    """

    name: str
    column: Callable[[Column, Column, Column], Column]
    merged: Callable[[Column, Column, Column], Column] | None = None


def _tagged(units: Column, source: Column, target: Column) -> Column:
    """Units with the tag between them: ``array_join`` runs in generated code, a function per unit does not."""
    tag = F.concat(F.lit("<"), target, F.lit("> "))
    joined = F.call_function("array_join", units, F.concat(F.lit(" "), tag))
    return F.when(F.size(units) > 0, F.concat(tag, joined)).otherwise(joined)


TAG = NativeBackend("tag", lambda text, source, target: F.concat(F.lit("<"), target, F.lit("> "), text), _tagged)
IDENTITY = NativeBackend("identity", lambda text, source, target: text)


@dataclass(frozen=True)
class MemoryBackend:
    """A table ``(source, target, text, translation[, score])``; with several candidates the best counts.

    A text that is not in the table keeps its source form, or makes the translation null if
    ``keep_missing`` is off.
    """

    table: DataFrame
    name: str = "memory"
    keep_missing: bool = True


@dataclass(frozen=True)
class LexiconBackend:
    """A table ``(source, target, text, translation[, score])`` of lower-case words. Unknown words stay."""

    table: DataFrame
    name: str = "lexicon"
    keep_missing: bool = True


def candidate_rank(table: DataFrame) -> Column:
    """Order of competing translations: score, then text, so that ties are broken the same way every time."""
    known = F.col("translation").isNotNull()
    if "score" in table.columns:
        return F.struct(known, "score", "translation")
    return F.struct(known, "translation")


def best_candidates(table: DataFrame) -> DataFrame:
    """One ``(source, target, text, translation)`` per text and pair."""
    return table.groupBy("source", "target", "text").agg(
        F.max_by("translation", candidate_rank(table)).alias("translation")
    )
