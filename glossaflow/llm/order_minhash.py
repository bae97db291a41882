"""Order MinHash fingerprints, in built-in functions only.

A text becomes tokens: words between white space, and single characters where a script does without spaces or a run is
longer than ``WORD_CHARS``, so that an edit changes the tokens around it and none after it. Its k-mers are ``K`` tokens
in a row, told apart by occurrence: the second time a k-mer comes up it is another element. A hash deals the
elements into ``BINS`` bins; from the start of each filled bin, the two elements of least hash are selected (of a bin with
one element, the second is the next one by hash, around the end to the first) and put back into their order
in the text, and the hash of that ordered tuple is the bin's signature. Only a text of one element has no order. Moving, inserting or replacing text changes
selected elements or their order, so the share of equal signatures falls with edit distance; multisets that are
equal but differently ordered are told apart.

A fingerprint is the signatures as hex, four digits each; ``----`` stands for an empty bin. The likeness of two
fingerprints is the share of equal bins among those that are not empty in both (1 if all are).

All work on a text stays within its row (sorting and folding arrays of numbers), so nothing is shuffled and no
group of k-mers is gathered; occurrences are numbered by the runs of equal values in the sorted array.

Results: null texts count as empty; empty fingerprints are like each other; equal texts have equal fingerprints.
Token positions beyond 2^24 wrap around, which blurs the order of tuples in texts of that length only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossaflow.llm.common import quoted
from glossaflow.scratch import scratch_folder, stage

K = 3
BINS = 64
WORD_CHARS = 24
# Code points of scripts that set spaces between words. Others (Thai, Lao, Tibetan, Myanmar, Khmer, Han,
# kana) are taken by character. Ranges, since script properties are slow to match.
_SPACED = "[{}]".format("".join(
    r"\x{%s}-\x{%s}" % tuple(r.split("-"))
    for r in "21-dff 10a0-177f 1800-2e7f 3130-318f a000-a9df aa80-d7ff e000-f8ff fb00-feff 10000-1ffff".split()
))
_TOKEN = rf"(?<!{_SPACED}){_SPACED}{{1,{WORD_CHARS}}}+(?!{_SPACED})|\S"
EMPTY_BIN = "----"
_PLACES = (1 << 24) - 1


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _packed(value: Column, place: Column) -> Column:
    """40 bits of a hash above 24 bits of a place: sorts by hash, then by place."""
    return F.shiftleft(value, 24).bitwiseOR(place.cast("long").bitwiseAND(F.lit(_PLACES)))


def _when_any(array: str, value: Column, kind: str) -> Column:
    return F.when(F.size(array) > 0, value).otherwise(F.array().cast(kind))


def _kmers(tokens: str) -> Column:
    """Sorted packed k-mers; a text of fewer tokens has one k-mer, all of them."""
    places = F.sequence(F.lit(0), F.greatest(F.size(tokens) - K, F.lit(0)))
    kmer = F.transform(places, lambda i: _packed(F.xxhash64(*(F.get(tokens, i + j) for j in range(K))), i))
    return _when_any(tokens, F.sort_array(kmer), "array<bigint>")


def _begins(array: str, part: Callable[[Column], Column]) -> Column:
    """Where a new value of ``part`` begins in a sorted array."""
    places = F.sequence(F.lit(0), F.size(array) - 1)
    new = F.filter(places, lambda i: (i == 0) | (part(F.get(array, i)) != part(F.get(array, i - 1))))
    return _when_any(array, new, "array<int>")


def _elements(kmers: str, begins: str) -> Column:
    """Sorted packed elements: k-mers numbered by occurrence, which is the place in their run."""
    runs = F.transform(
        begins, lambda at, r: F.sequence(F.lit(0), F.coalesce(F.get(begins, r + 1), F.size(kmers)) - at - 1)
    )
    element = F.zip_with(
        kmers, F.flatten(runs),
        lambda value, number: _packed(F.xxhash64(_hash(value), number), value.bitwiseAND(F.lit(_PLACES))),
    )
    return F.sort_array(element)


def _signatures(elements: str, begins: str) -> Column:
    """Signature by bin: of the two least elements from the start of a bin, in text order."""

    def of_bin(i: Column) -> Column:
        first, second = F.get(elements, i), F.coalesce(F.get(elements, i + 1), F.get(elements, F.lit(0)))
        alone = F.size(elements) == 1
        in_order = first.bitwiseAND(F.lit(_PLACES)) <= second.bitwiseAND(F.lit(_PLACES))
        a, b = _hash(first), _hash(second)
        value = F.when(alone, F.xxhash64(a)).when(in_order, F.xxhash64(a, b)).otherwise(F.xxhash64(b, a))
        return F.struct(_bin(first).alias("bin"), value.bitwiseAND(F.lit(0xFFFF)).cast("int").alias("value"))

    return F.map_from_entries(F.transform(begins, of_bin))


def with_signatures(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``df`` with an ``array<int>`` of ``BINS`` signatures (-1: empty) per entry ``{result: text column}``.

    Each step is a projection of its own: what a fold refers to in every turn must be a column, not an expression.
    """

    def step(df: DataFrame, make: Callable[[str], Column], suffix: str, used: str) -> DataFrame:
        gone = {f"__{name}{c}" for name in texts for c in used}
        return df.select(*(c for c in df.columns if c not in gone),
                         *(make(f"__{name}").alias(f"__{name}{suffix}") for name in texts))

    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    df = df.select(*df.columns, *(_tokens(F.coalesce(F.col(text), F.lit(""))).alias(f"__{name}t")
                                  for name, text in texts.items()))
    df = step(df, lambda n: _kmers(f"{n}t"), "k", "t")
    df = step(df, lambda n: _begins(f"{n}k", _hash), "b", "")
    df = step(df, lambda n: _elements(f"{n}k", f"{n}b"), "e", "kb")
    df = step(df, lambda n: _begins(f"{n}e", _bin), "b", "")
    df = step(df, lambda n: _signatures(f"{n}e", f"{n}b"), "m", "eb")
    made = {name: _by_bin(f"__{name}m", bins) for name in texts}
    gone = {f"__{name}m" for name in texts}
    return df.select(*(c for c in df.columns if c not in gone), *(value.alias(name) for name, value in made.items()))


def _by_bin(signatures: str, bins: Column) -> Column:
    # Two references keep the map a column: one would be folded into the lambda and built anew for every bin.
    found = F.transform(bins, lambda i: F.coalesce(F.try_element_at(F.col(signatures), i), F.lit(-1)))
    return F.when(F.size(F.map_keys(signatures)) >= 0, found)


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, 24)


def _bin(packed: Column) -> Column:
    """The top bits of a packed element, so that bins are runs of the sorted array."""
    return F.shiftright(packed, 64 - (BINS.bit_length() - 1)).cast("int") + BINS // 2


def as_text(signatures: str) -> Column:
    """The fingerprint of an array of signatures."""
    digits = lambda v: F.when(v < 0, EMPTY_BIN).otherwise(F.lower(F.lpad(F.hex(v), 4, "0")))
    return F.array_join(F.transform(F.col(signatures), digits), "")


def likeness(a: str, b: str) -> Column:
    """Share of equal bins among those that one of the two arrays fills."""
    both = F.zip_with(F.col(a), F.col(b), lambda x, y: F.when(x != y, 1).when(x < 0, 3).otherwise(2))
    differ = F.size(F.filter(both, lambda v: v == 1))
    equal = F.size(F.filter(both, lambda v: v == 2))
    return F.when(differ + equal == 0, 1.0).otherwise(equal / (differ + equal))


def next_ids(ids: DataFrame) -> DataFrame:
    """``(id, m, next_id)`` for ``(id, m)`` with distinct ids: the next smaller one; after the least, the greatest.

    Ids are cut into ranges; within a range a window looks ahead, and the last of each range gets the first of the
    next, over one row per range. A null id counts as the least.
    """
    order = F.col("id").desc_nulls_last()
    ranged = stage(
        ids.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "ids", scratch_folder(ids.sparkSession)
    )
    within = ranged.withColumn("next", F.lead(F.struct("id")).over(Window.partitionBy("range").orderBy(order)))
    heads = ranged.groupBy("range").agg(F.max_by(F.struct("id"), F.coalesce("id", F.lit(-(1 << 63)))).alias("head"))
    # One row per range, of which there are as many as shuffle partitions.
    ring = Window.orderBy("range")
    every = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        "range", F.coalesce(F.lead("head").over(ring), F.first("head").over(every)).alias("after")
    )
    return within.join(F.broadcast(after), "range").select(
        "id", "m", F.coalesce("next", "after")["id"].alias("next_id")
    )


def with_edited(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, next_id, text, edited)``: the last third of each text replaced by as much of the next document's start.

    Of rows that share an id, the one of the least text hash is the next document of others; all are returned.
    """
    rows = docs.select(quoted(id_column).cast("long").alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")
    chain = stage(
        next_ids(rows.groupBy("id").agg(F.max(third).alias("m"))), "chain", scratch_folder(docs.sparkSession)
    )
    place = Window.partitionBy("id").orderBy(F.xxhash64("text"), "text")
    alone = stage(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "twice",
                  scratch_folder(docs.sparkSession))
    if not alone.isEmpty():
        leaders = rows.withColumn("place", F.row_number().over(place)).where("place = 1").drop("place")
    else:
        leaders = rows
    wanted = chain.select(F.col("id").alias("for_id"), "m", "next_id")
    starts = leaders.join(wanted.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("next_id"))).select(
        "for_id", "next_id", F.left("text", F.col("m")).alias("start")
    )
    own = F.col("id").eqNullSafe(F.col("for_id"))
    return rows.join(starts.hint("shuffle_hash"), own).select(
        "id", "next_id", "text",
        F.concat(F.left("text", F.length("text") - third), F.left("start", third)).alias("edited"),
    )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``."""
    folder = scratch_folder(docs.sparkSession)
    edited = with_edited(docs, id_column, text).select(
        "id", "next_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.xxhash64("text").alias("hash"), "text", "edited",
    )
    marked = with_signatures(edited, {"own": "text", "other": "edited"})
    marked = stage(marked.drop("text", "edited"), "signatures", folder)
    first = marked.groupBy("id").agg(F.min_by("own", F.struct("hash", "n_chars")).alias("following"))
    first = first.select(F.col("id").alias("leader"), "following")
    joined = marked.join(first, F.col("next_id").eqNullSafe(F.col("leader")))
    return joined.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        as_text("own").alias("fingerprint"), as_text("other").alias("edited_fingerprint"),
        likeness("own", "other").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )
