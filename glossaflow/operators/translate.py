"""Translate text columns of a DataFrame into any number of languages.

The shape of the job follows the backend:

* A native backend needs no shuffle. Texts are cut, fanned out over the targets and merged in one stage.
* A memory is looked up by the content of the units (sentences or texts). The texts are cut once, into a written
  table of arrays. Their units then travel as a 16-byte content id each to meet the memory, which is keyed by the
  same ids, and the translations found come back to the row of the cut table; no unit crosses the network
  as a text. Targets travel in blocks, as a short array per unit, and a row per target is made of finished texts
  only, so a corpus with a hundred targets does not shuffle a hundred copies of its units.
* A word list meets the words as they are, which are shorter than an id.
* A function backend is called once per distinct unit and target. The answers are written as a table that also holds
  the places of each unit; from there the translations go back to the rows of the texts, a part of the rows at a time.
  Answers in a store that outlives the call serve as a memory instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glossaflow.functions.text import ENGLISH, SplitRules, merge_sentences, split_sentences, strip_newlines
from glossaflow.operators.backends import LexiconBackend, MemoryBackend, NativeBackend, candidate_rank
from glossaflow.operators.batching import FunctionBackend, answer_columns, answer_texts, apply_function, callers
from glossaflow.operators.skew import MIN_HOT_ROWS, fits_broadcast, hashed, hot_keys, id_join, lookup_join
from glossaflow.registry.languages import literal_list
from glossaflow.scratch import brief_shuffles, discard, path_exists, scratch_folder, stage

Backend = NativeBackend | MemoryBackend | LexiconBackend | FunctionBackend

# Source of rows whose language is not known (the ISO 639 code for "undetermined").
UNDETERMINED = "und"

# Targets handled together; bounds what one text can grow to inside a task.
TARGETS_PER_BLOCK = 16

# For tables of texts and their translations, which repeat each other.
COMPRESSION = "zstd"

# Parts in which units go to the function and translations back to their texts, from MIN_HOT_ROWS units on: the shuffle
# files of one part are gone before the next begins.
PARTS = 3


@dataclass(frozen=True)
class Cutting:
    """How a text becomes units: sentences by default; whole texts with ``sentences=False``."""

    sentences: bool = True
    drop_newlines: bool = False
    rules: SplitRules = ENGLISH

    def units(self, text: Column) -> Column:
        if self.drop_newlines:
            text = strip_newlines(text)
        return split_sentences(text, self.rules) if self.sentences else F.when(text.isNotNull(), F.array(text))

    def words(self, text: Column) -> Column:
        """Blank-separated words. Glued with blanks they give the text back, sentence by sentence."""
        if self.drop_newlines:
            text = strip_newlines(text)
        if self.sentences:
            text = merge_sentences(split_sentences(text, self.rules))
            return F.array_remove(F.split(text, " "), F.lit(""))
        return F.split(text, " ")


SENTENCES = Cutting()
WHOLE_TEXTS = Cutting(sentences=False)


def with_known_source(df: DataFrame, column: str = "source") -> DataFrame:
    """Rows without a source language get :data:`UNDETERMINED`, so that they are translated like all others."""
    return df.withColumn(column, F.coalesce(column, F.lit(UNDETERMINED)))


def _blocks(targets: Sequence[str]) -> list[list[str]]:
    return [list(targets[i : i + TARGETS_PER_BLOCK]) for i in range(0, len(targets), TARGETS_PER_BLOCK)]


def _block_targets(targets: Sequence[str]) -> Column:
    """Target codes of the row's block."""
    return F.get(literal_list(_blocks(targets)), F.col("__block"))


def _block_key(targets: Sequence[str]) -> list[str]:
    """The block as a key column; a constant one would only keep the table from being joined as it lies."""
    return ["__block"] if len(_blocks(targets)) > 1 else []


def _with_block(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    n = len(_blocks(targets))
    if n == 1:
        return df.withColumn("__block", F.lit(0))
    return df.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _fan_out(df: DataFrame, targets: Sequence[str], columns: list) -> DataFrame:
    """One row per target of the row's block other than its own language. Adds ``target`` and ``__slot``."""
    return df.select(*columns, F.posexplode(_block_targets(targets)).alias("__slot", "target")).where(
        F.col("target") != F.col("source")
    )


def explode_units(df: DataFrame, keys: Sequence[str], cutting: Cutting, words: bool = False) -> DataFrame:
    """Units of all keys as rows ``(row_id, source, __rest, __key, __present, __pos, text)``.

    A text without units still gives one row. The columns that are not translated ride on the first unit of
    the first key only.
    """
    rest = F.struct(*[c for c in df.columns if c not in keys])
    texts = df.select(
        "row_id", "source", rest.alias("__rest"), F.posexplode(F.array(*keys)).alias("__key", "__whole")
    )
    cut = cutting.words if words else cutting.units
    units = texts.select(
        "row_id",
        "source",
        "__rest",
        "__key",
        F.col("__whole").isNotNull().alias("__present"),
        F.posexplode_outer(cut(F.col("__whole"))).alias("__pos", "text"),
    )
    first = (F.col("__key") == 0) & F.coalesce(F.col("__pos") == 0, F.lit(True))
    return units.withColumn("__rest", F.when(first, F.col("__rest")))


def content_id(source: Column, text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text of a language: ``__id``, which is :func:`key_hash` of both, and ``__id2``."""
    return [F.xxhash64(source, text).alias("__id"), F.xxhash64(text, source).alias("__id2")]


ID = ["__id", "__id2"]


def _lookup_side(table: DataFrame, targets: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The best translation of every key, as one array over the slots of a block of targets."""
    place = F.array_position(literal_list(targets), F.col("target")).cast("int") - 1
    rank = candidate_rank(table)
    placed = table.where(F.col("target").isin(list(targets))).withColumns(
        {"__block": F.floor(place / TARGETS_PER_BLOCK).cast("int"), "__slot": place % TARGETS_PER_BLOCK}
    )

    def best(slot: int) -> Column:
        here = F.col("__slot") == slot
        return F.max_by(F.when(here, F.col("translation")), F.when(here, rank))

    return placed.groupBy(*keys, *_block_key(targets)).agg(
        F.array(*[best(i) for i in range(len(_blocks(targets)[0]))]).alias("__hits")
    )


def _n_units(n_keys: int) -> Column:
    return sum((F.coalesce(F.array_size(f"__units{i}"), F.lit(0)) for i in range(n_keys)), F.lit(0))


def _finished(
    ready: DataFrame, rest: Sequence[str], keys: Sequence[str], targets: Sequence[str], keep_missing: bool
) -> DataFrame:
    """One row per target of a row's block, with finished texts.

    ``ready`` holds, for the i-th key, ``__present<i>``, the array ``__units<i>`` and the aligned array ``__hits<i>`` of
    translations by slot; where no unit is kept for want of a translation, the units may be left out if ``__n_units`` counts them. All texts of a block are made in the row, slot by slot; the row per target gets its own ones only.
    """
    slots = F.lit(list(range(len(_blocks(targets)[0]))))

    def text(i: int, slot: Column) -> Column:
        found = F.zip_with(f"__units{i}", f"__hits{i}", lambda u, h: F.coalesce(F.get(h, slot), u))
        return F.array_join(found, " ")

    def missing(i: int, slot: Column) -> Column:
        return F.size(F.filter(f"__hits{i}", lambda h: F.get(h, slot).isNull()))

    def at(slot: Column) -> Column:
        absent = {f"__n{i}": missing(i, slot) for i in range(len(keys))}
        return F.struct(
            F.get(_block_targets(targets), slot).alias("target"),
            *[text(i, slot).alias(f"__text{i}") for i in range(len(keys))],
            *[n.cast("long").alias(name) for name, n in absent.items()],
        )

    n_units = F.col("__n_units") if "__n_units" in ready.columns else _n_units(len(keys))
    made = ready.withColumns({"__made": F.transform(slots, at), "n_units": n_units.cast("long")})
    present = [f"__present{i}" for i in range(len(keys))]
    fanned = made.select(*rest, *present, "n_units", F.inline("__made")).where("target is not null and target != source")

    def usable(i: int) -> Column:
        there = F.col(f"__present{i}")
        return F.when(there if keep_missing else there & (F.col(f"__n{i}") == 0), F.col(f"__text{i}"))

    n_missed = sum((F.col(f"__n{i}") for i in range(len(keys))), F.lit(0).cast("long"))
    lacking = "miss" if keep_missing else "failed"
    return fanned.select(
        *rest,
        "target",
        *[usable(i).alias(key) for i, key in enumerate(keys)],
        "n_units",
        n_missed.alias("n_missed"),
        F.when(n_missed > 0, lacking).otherwise("ok").alias("status"),
    )


def cut_once(
    df: DataFrame, keys: Sequence[str], cutting: Cutting, own: Sequence[str], folder: str | None = None
) -> tuple[DataFrame, int]:
    """The texts as arrays of units, written: ``__units<i>`` for the i-th key; and the number of units. Rows whose
    language is among ``own`` keep their texts in ``__own``."""
    rest = [c for c in df.columns if c not in keys]
    originals = F.when(F.col("source").isin(list(own)), F.struct(*keys)).alias("__own")
    units = {f"__units{i}": cutting.units(F.col(k)) for i, k in enumerate(keys)}
    counted = Observation()
    n = _n_units(len(keys))
    rows = df.select(*rest, *[u.alias(name) for name, u in units.items()], originals)
    cut = stage(rows.observe(counted, F.sum(n.cast("long")).alias("n")), "cut", folder, COMPRESSION)
    return cut, counted.get["n"] or 0


def _units_of_cut(cut: DataFrame, n_keys: int) -> DataFrame:
    """``(row_id, source, __key, __pos, text)`` of every unit."""
    arrays = F.array(*[f"__units{i}" for i in range(n_keys)])
    texts = cut.select("row_id", "source", F.posexplode(arrays).alias("__key", "__whole"))
    return texts.select("row_id", "source", "__key", F.posexplode("__whole").alias("__pos", "text"))


def _memory_side(table: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The memory by content id. As a written table it reaches the join by a plain exchange, which adaptive skew
    splitting needs."""
    table = table.where(F.col("source").isNotNull() & F.col("text").isNotNull())
    known = table.select("*", *content_id(F.col("source"), F.col("text")))
    return stage(_lookup_side(known, targets, ID), "lookup")


def _translate_by_content(
    cut: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    keep_missing: bool,
    hot: Sequence[int] | None,
    rebalance: Sequence[str] | None,
) -> DataFrame:
    rest = [c for c in cut.columns if not c.startswith("__")]

    def ids_of(rows: DataFrame) -> DataFrame:
        units = _units_of_cut(rows, len(keys))
        return units.select("row_id", "__key", "__pos", *content_id(F.col("source"), F.col("text")))

    if hot is None:
        hot = hot_keys(cut, ids_of, ["__id"], F.col("__id"))
    units = _with_block(ids_of(cut), targets)
    joined = id_join(units, side, [*ID, *_block_key(targets)], F.xxhash64("row_id", "__key", "__pos"), hot)
    found = F.struct("__key", "__pos", "__hits")
    merged = joined.groupBy("row_id", "__block").agg(F.sort_array(F.collect_list(found)).alias("__found"))
    nothing = F.array().cast("array<string>")
    rows = _with_block(cut.drop("__own"), targets)
    ready = rows.join(merged, ["row_id", "__block"], "left").select(
        *rest,
        "__block",
        *[F.col(f"__units{i}").isNotNull().alias(f"__present{i}") for i in range(len(keys))],
        *[F.coalesce(f"__units{i}", nothing).alias(f"__units{i}") for i in range(len(keys))],
        *[_hits_of_key(i, len(keys)).alias(f"__hits{i}") for i in range(len(keys))],
    )
    if rebalance is not None:
        ready = ready.hint("rebalance", "__block", *rebalance)
    return _finished(ready, rest, keys, targets, keep_missing)


def _hits_of_key(i: int, n_keys: int) -> Column:
    mine = F.filter("__found", lambda u: u["__key"] == i) if n_keys > 1 else F.col("__found")
    return F.coalesce(F.transform(mine, lambda u: u["__hits"]), F.array().cast("array<array<string>>"))


def _translate_by_calls(
    cut: DataFrame,
    n_units: int,
    keys: Sequence[str],
    targets: Sequence[str],
    backend: FunctionBackend,
    hot: Sequence[int] | None,
    rebalance: Sequence[str] | None,
    folder: str,
) -> tuple[DataFrame, DataFrame]:
    """The rows translated by calls whose answers serve this run alone, and the rows of ``cut`` without their units.

    A row of the answers knows the places of its text, so translations go straight back to their rows: answers are
    neither aggregated nor joined with the units. Only those of hot units, which have too many places for one row, are
    sent to all tasks and joined. ``cut`` and the answers are deleted when they are used up.
    """
    spark, n_parts = cut.sparkSession, PARTS if n_units >= MIN_HOT_ROWS else 1
    place = F.struct("row_id", "__key", "__pos")
    units = _units_of_cut(cut, len(keys)).select("*", *content_id(F.col("source"), F.col("text")))
    if hot is None:
        hot = hot_keys(cut, lambda rows: _units_of_cut(rows, len(keys)).select(*content_id(F.col("source"), F.col("text"))),
                       ["__id"], F.col("__id")) if n_units >= MIN_HOT_ROWS else ()
    is_hot = F.col("__id").isin(list(hot))
    for part in range(n_parts):
        of_part = units.where(F.pmod("__id", F.lit(n_parts)) == part) if n_parts > 1 else units
        texts = of_part.groupBy(*ID).agg(
            F.first("source").alias("source"), F.first("text").alias("text"),
            F.collect_list(F.when(~is_hot, place) if hot else place).alias("__places"),
        )
        dealt = texts.repartition(callers(texts, backend), *ID)
        written = _answered(dealt, targets, backend, f"{folder}/answers/part{part}", ["source", "text"])
    answers = spark.read.schema(written.schema).parquet(f"{folder}/answers/*/translations").withColumn(
        "__hits", F.col("__answers.translation")
    )
    units_of_hot = stage(units.where(is_hot).select("row_id", "__key", "__pos", *ID), "hot", folder) if hot else None
    units_kept = [F.when(F.col("row_id").isNull(), F.col(f"__units{i}")) for i in range(len(keys))]
    rows = stage(cut.select(
        *[c for c in cut.columns if not c.startswith("__units")],
        *[F.col(f"__units{i}").isNotNull().alias(f"__present{i}") for i in range(len(keys))],
        *[u.alias(f"__units{i}") for i, u in enumerate(units_kept)],
        _n_units(len(keys)).alias("__n_units"),
    ), "rows", folder, COMPRESSION)
    discard(spark, folder, "cut")
    rest = [c for c in cut.columns if not c.startswith("__")]
    found = answers.select("__block", F.explode("__places").alias("__place"), "__hits").select(
        "__place.*", "__block", "__hits"
    )
    if hot:
        of_hot = F.broadcast(answers.where(is_hot).select(*ID, "__block", "__hits"))
        found = found.unionByName(units_of_hot.join(of_hot, ID).select("row_id", "__key", "__pos", "__block", "__hits"))
    nothing = F.array().cast("array<string>")
    of_row = F.pmod(F.xxhash64("row_id"), F.lit(n_parts))
    for part in range(n_parts):
        # the texts come together in one shuffle; adaptive coalescing may join its partitions
        merged = found.where(of_row == part).repartition("row_id").groupBy("row_id", *_block_key(targets)).agg(
            F.sort_array(F.collect_list(F.struct("__key", "__pos", "__hits"))).alias("__found")
        )
        here = _with_block(rows.drop("__own").where(of_row == part), targets)
        ready = here.join(merged, ["row_id", *_block_key(targets)], "left").select(
            *rest,
            "__block",
            "__n_units",
            *[f"__present{i}" for i in range(len(keys))],
            *[F.coalesce(f"__units{i}", nothing).alias(f"__units{i}") for i in range(len(keys))],
            *[_hits_of_key(i, len(keys)).alias(f"__hits{i}") for i in range(len(keys))],
        )
        with brief_shuffles(spark):
            stage(ready, f"part{part}", f"{folder}/ready", COMPRESSION)
    discard(spark, folder, "answers", "hot")
    done = spark.read.schema(ready.schema).parquet(f"{folder}/ready/*")
    if rebalance is not None:
        done = done.hint("rebalance", "__block", *rebalance)
    return _finished(done, rest, keys, targets, False), rows


def _translate_by_words(
    df: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    backend: LexiconBackend,
    cutting: Cutting,
    hot: Sequence[int] | None,
    rebalance: Sequence[str] | None,
) -> DataFrame:
    def units_of(rows: DataFrame) -> DataFrame:
        units = explode_units(rows, keys, cutting, words=True).withColumnRenamed("text", "__unit")
        return units.withColumn("text", F.lower("__unit"))

    side = _lookup_side(hashed(backend.table, ["source", "text"]), targets, ["__hash", "source", "text"])
    if fits_broadcast(backend.table, ["source", "target", "text", "translation"]):
        # words stay where they are; a longer word list takes the salted join
        side, hot = F.broadcast(side), ()
    else:
        side = stage(side, "lookup")
        if hot is None:
            hot = hot_keys(df, units_of, ["source", "text"])
    joined = lookup_join(
        _with_block(units_of(df), targets),
        side,
        ["source", "text"],
        F.xxhash64("row_id", "__key", "__pos"),
        hot,
        also=_block_key(targets),
    )
    unit = F.struct("__key", "__pos", "__unit", "__hits")
    merged = joined.groupBy("row_id", "__block").agg(
        F.first("__rest", ignorenulls=True).alias("__rest"),
        F.sort_array(F.collect_list(F.when(F.col("__pos").isNotNull(), unit))).alias("__found"),
        *[
            F.bool_or(F.when(F.col("__key") == i, F.col("__present"))).alias(f"__present{i}")
            for i in range(len(keys))
        ],
    )

    def part(i: int, name: str) -> Column:
        mine = F.filter("__found", lambda u: u["__key"] == i) if len(keys) > 1 else F.col("__found")
        return F.transform(mine, lambda u: u[name])

    rest = [c for c in df.columns if c not in keys]
    ready = merged.select(
        *[F.col("__rest")[c].alias(c) for c in rest],
        "__block",
        *[f"__present{i}" for i in range(len(keys))],
        *[part(i, "__unit").alias(f"__units{i}") for i in range(len(keys))],
        *[part(i, "__hits").alias(f"__hits{i}") for i in range(len(keys))],
    )
    if rebalance is not None:
        ready = ready.hint("rebalance", "__block", *rebalance)
    return _finished(ready, rest, keys, targets, backend.keep_missing)


def _translate_natively(
    df: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    backend: NativeBackend,
    cutting: Cutting,
    rebalance: Sequence[str] | None,
) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    helpers = [f"__units{i}" for i in range(len(keys))]
    cut = df.select(*rest, *[cutting.units(F.col(k)).alias(h) for k, h in zip(keys, helpers)])
    cut = _with_block(cut, targets)
    if rebalance is not None:
        cut = cut.hint("rebalance", "__block", *rebalance)
    fanned = _fan_out(cut, targets, [*rest, *helpers])
    source, target = F.col("source"), F.col("target")

    def merged_text(helper: str) -> Column:
        if not cutting.sentences:
            return backend.column(F.get(helper, F.lit(0)), source, target)
        if backend.merged:
            return backend.merged(F.col(helper), source, target)
        return merge_sentences(F.transform(helper, lambda unit: backend.column(unit, source, target)))

    n_units = sum((F.greatest(F.coalesce(F.size(h), F.lit(0)), F.lit(0)) for h in helpers), F.lit(0))
    return fanned.select(
        *rest,
        "target",
        *[merged_text(h).alias(k) for h, k in zip(helpers, keys)],
        n_units.cast("long").alias("n_units"),
        F.lit(0).cast("long").alias("n_missed"),
        F.lit("ok").alias("status"),
    )


def _ask(texts: DataFrame, targets: Sequence[str], backend: FunctionBackend, store: str) -> DataFrame:
    """Have distinct ``(source, text, n_rows)`` answered, and return the stored answers to the targets.

    Pairs already answered in ``store`` are not sent again, so an interrupted or repeated run goes on where the last
    one stopped.
    """
    spark = texts.sparkSession
    wanted = literal_list(targets)
    done = read_store(spark, store)
    if done is not None:
        # one set of answered targets per text: the texts keep their partitioning and are not yet fanned out
        answered = (
            done.where(F.col("status") == "ok").groupBy("source", "text").agg(F.collect_set("target").alias("__done"))
        )
        texts = texts.join(answered, ["source", "text"], "left")
        wanted = F.array_except(wanted, F.coalesce("__done", F.array().cast("array<string>")))
    # texts are dealt out before the fan-out, which then needs no shuffle; adaptive coalescing, which counts
    # bytes and not calls, does not touch this partitioning
    calls = (
        texts.select("source", "text", "n_rows", F.array_remove(wanted, F.col("source")).alias("__targets"))
        .where(F.size("__targets") > 0)
        .repartition(callers(texts, backend), "source", "text")
        .select("source", F.explode("__targets").alias("target"), "text", "n_rows")
    )
    answers = apply_function(calls, backend)
    # tasks commit straight into the store, so what was answered before a job failed is kept
    answers.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(store)
    return spark.read.schema(answers.schema).parquet(store).where(F.col("target").isin(list(targets)))


def _answered(
    texts: DataFrame, targets: Sequence[str], backend: FunctionBackend, folder: str | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """The answers to distinct texts, which lie as they are to be called, as a table with a row per text and block."""
    answers = answer_texts(_with_block(texts, targets), _blocks(targets), backend)
    # side by side, as translations of one text repeat each other's names and numbers
    slots = [F.struct(*[F.col(c).alias(name) for name, c in answer_columns(i).items()]) for i in range(len(_blocks(targets)[0]))]
    shown = answers.select(*texts.columns, "__block", F.array(*slots).alias("__answers")).drop(*drop)
    with brief_shuffles(texts.sparkSession):
        return stage(shown, "translations", folder, COMPRESSION)


def distinct_units(units: DataFrame) -> DataFrame:
    """``(source, text, n_rows)`` of ``(source, text)`` rows; null texts are left out."""
    return units.where(F.col("text").isNotNull()).groupBy("source", "text").agg(F.count("*").alias("n_rows"))


def translate_units(
    units: DataFrame, targets: Sequence[str], backend: FunctionBackend, store: str | None = None
) -> DataFrame:
    """Call the function once per distinct ``(source, text)`` and target and keep the answers as a table.

    ``store`` names the table's folder; what is answered there is not asked again. Returns ``(source, target, text,
    translation, n_rows, status, attempts, error)``, one row per wanted text and target: an ``ok`` answer if there is one.
    """
    texts = distinct_units(with_known_source(units))
    kept = ["translation", "status", "attempts", "error"]
    if store is None:
        # a table of this call alone holds one answer to each text and target: nothing to choose from, nothing to join
        targets = list(dict.fromkeys(targets))
        answers = _answered(texts.repartition(callers(texts, backend), "source", "text"), targets, backend)
        slots = F.transform("__answers", lambda answer, i: F.struct(
            F.get(_block_targets(targets), i).alias("target"), *[answer[c].alias(c) for c in kept]
        ))
        rows = answers.select("source", "text", "n_rows", F.inline(slots))
        return rows.where("target is not null and target != source").select(
            "source", "target", "text", "translation", "n_rows", *kept[1:]
        )
    stored = _ask(texts, targets, backend, store)
    best = F.max_by(F.struct(*kept), F.struct(F.col("status") == "ok", "attempts", "translation"))
    one = stored.groupBy("source", "text", "target").agg(best.alias("__best"))
    return one.join(texts, ["source", "text"]).select(
        "source", "target", "text", "__best.translation", "n_rows", *[F.col("__best")[c].alias(c) for c in kept[1:]]
    )


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The stored answers, or None before the first run."""
    if not path_exists(spark, store):
        return None
    try:
        return spark.read.parquet(store)
    except AnalysisException as problem:
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # no task of an earlier run got that far
            return None
        raise


def translate(
    df: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str],
    backend: Backend,
    cutting: Cutting = SENTENCES,
    *,
    copy_own_language: bool = True,
    hot: Sequence[int] | None = None,
    rebalance: Sequence[str] | None = None,
    store: str | None = None,
) -> DataFrame:
    """One row per input row and target language, with ``keys`` translated.

    ``df`` holds ``row_id`` (unique), ``source`` (language code; null becomes ``und``), the string columns
    ``keys`` and any other columns, which are kept. Adds ``target``, ``n_units``, ``n_missed`` and ``status``. Null stays null and
    blank becomes empty. A row whose language is among the targets is copied unchanged for that target
    (``status='copied'``), or left out with ``copy_own_language=False``.

    ``hot`` holds hashes of ``(source, text)`` to spread in lookups; by default a sketch finds them.
    ``rebalance`` evens out the rows per target block and the named columns before the fan-out, for a
    partitioned write.
    """
    targets = list(dict.fromkeys(targets))
    if not targets:
        raise ValueError("no target languages")
    taken = {"target", "n_units", "n_missed", "status"} & set(df.columns)
    if taken:
        raise ValueError(f"columns the result adds are already there: {', '.join(sorted(taken))}")
    df = with_known_source(df)
    if isinstance(backend, (MemoryBackend, FunctionBackend)):
        originals = targets if copy_own_language else ()
        if isinstance(backend, MemoryBackend):
            # neither job waits for the other
            with ThreadPoolExecutor(1) as pool:
                reduced = pool.submit(_memory_side, backend.table, targets)
                cut, n_units = cut_once(df, keys, cutting, originals)
                side, keep_missing = reduced.result(), backend.keep_missing
        elif store is not None:
            cut, n_units = cut_once(df, keys, cutting, originals)
            texts = distinct_units(_units_of_cut(cut, len(keys)))
            earlier = read_store(df.sparkSession, store) is not None
            stored = _ask(texts, targets, backend, store)
            answers = stored.where(F.col("status") == "ok")
            if earlier:  # it may hold far more than this corpus
                answers = answers.join(texts, ["source", "text"], "left_semi")
            side, keep_missing = _memory_side(answers, targets), False
        else:
            folder = scratch_folder(df.sparkSession)
            cut, n_units = cut_once(df, keys, cutting, originals, folder)
            out, cut = _translate_by_calls(cut, n_units, keys, targets, backend, hot, rebalance, folder)
        if isinstance(backend, MemoryBackend) or store is not None:
            if n_units < MIN_HOT_ROWS and hot is None:
                hot = ()  # no unit can occur often enough
            out = _translate_by_content(cut, side, keys, targets, keep_missing, hot, rebalance)
        own = cut.where(F.col("__own").isNotNull())
        texts_of_own = [F.col("__own")[k].alias(k) for k in keys]
    else:
        if isinstance(backend, NativeBackend):
            out = _translate_natively(df, keys, targets, backend, cutting, rebalance)
        else:
            out = _translate_by_words(df, keys, targets, backend, cutting, hot, rebalance)
        own, texts_of_own = df.where(F.col("source").isin(targets)), list(keys)
    if not copy_own_language:
        return out
    return out.unionByName(own.select(
        *[c for c in df.columns if c not in keys],
        F.col("source").alias("target"),
        *texts_of_own,
        F.lit(0).cast("long").alias("n_units"),
        F.lit(0).cast("long").alias("n_missed"),
        F.lit("copied").alias("status"),
    ))
