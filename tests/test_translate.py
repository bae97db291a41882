import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glossaflow.functions.text import split_sentences
from glossaflow.operators.backends import IDENTITY, TAG, LexiconBackend, MemoryBackend, best_candidates
from glossaflow.operators.batching import FunctionBackend
from glossaflow.operators.skew import hashed, hot_keys, key_hash, lookup_join
from glossaflow.operators.translate import (
    SENTENCES,
    WHOLE_TEXTS,
    Cutting,
    explode_units,
    read_store,
    translate,
    translate_units,
)
from glossaflow.scratch import scratch_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXTS = [
    (1, "eng_Latn", "en", "Good day. How are you? Fine.", "Good day."),
    (2, "eng_Latn", "en", None, "Short"),
    (3, "eng_Latn", "en", "", "  \n "),
    (4, "fra_Latn", "fr", "Bonjour. Ça va?", None),
    (5, "eng_Latn", "en", "Good day. Good day. Good day.", "x\ny"),
]
SCHEMA = "row_id long, source string, note string, a string, b string"
TARGETS = ["fra_Latn", "zul_Latn"]
COLUMNS = "source string, target string, text string, translation string, score double"


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, SCHEMA).cache()


@pytest.fixture(scope="module")
def memory(spark):
    return spark.createDataFrame(
        [
            ("eng_Latn", "fra_Latn", "Good day.", "Bonjour.", 0.9),
            ("eng_Latn", "fra_Latn", "Good day.", "Bon jour.", 0.4),
            ("eng_Latn", "fra_Latn", "How are you?", "Ça va?", 0.9),
            ("eng_Latn", "zul_Latn", "Good day.", "Sawubona.", 0.9),
            ("deu_Latn", "fra_Latn", "Fine.", "Bien.", 0.9),
            ("eng_Latn", "fra_Latn", "Good day. Good day. Good day.", "Whole.", 0.9),
        ],
        COLUMNS,
    ).cache()


def by_key(df, *columns):
    return {(row["row_id"], row["target"]): tuple(row[c] for c in columns) for row in df.collect()}


def marking(source, target, texts):
    return [f"{target}:{t}" for t in texts]


def backends(memory):
    return {
        "tag": TAG,
        "memory": MemoryBackend(memory),
        "lexicon": LexiconBackend(memory),
        "function": FunctionBackend(lambda: marking),
    }


@pytest.mark.parametrize("name", ["tag", "memory", "lexicon", "function"])
@pytest.mark.parametrize("cutting", [SENTENCES, WHOLE_TEXTS])
def test_one_row_per_row_and_target(texts, memory, name, cutting):
    out = translate(texts, ["a", "b"], TARGETS, backends(memory)[name], cutting).collect()
    assert sorted((r["row_id"], r["target"]) for r in out) == sorted((t[0], g) for t in TEXTS for g in TARGETS)
    for row in out:
        original = next(t for t in TEXTS if t[0] == row["row_id"])
        assert row["note"] == original[2]
        assert (row["a"] is None) == (original[3] is None)
        assert (row["b"] is None) == (original[4] is None)
        if row["target"] == row["source"]:
            assert (row["a"], row["b"], row["status"]) == (original[3], original[4], "copied")


def test_tag_by_sentence_and_by_text(texts):
    cut = by_key(translate(texts, ["a", "b"], TARGETS, TAG), "a", "b", "n_units")
    assert cut[1, "zul_Latn"] == ("<zul_Latn> Good day. <zul_Latn> How are you? <zul_Latn> Fine.", "<zul_Latn> Good day.", 4)
    assert cut[3, "zul_Latn"] == ("", "", 0)
    assert cut[2, "zul_Latn"] == (None, "<zul_Latn> Short", 1)
    whole = by_key(translate(texts, ["a", "b"], TARGETS, TAG, WHOLE_TEXTS), "a", "b")
    assert whole[5, "zul_Latn"] == ("<zul_Latn> Good day. Good day. Good day.", "<zul_Latn> x\ny")
    glued = by_key(translate(texts, ["a", "b"], TARGETS, TAG, Cutting(sentences=False, drop_newlines=True)), "b")
    assert glued[5, "zul_Latn"] == ("<zul_Latn> xy",)


def test_memory_takes_the_best_candidate_and_keeps_misses(texts, memory):
    got = by_key(translate(texts, ["a", "b"], TARGETS, MemoryBackend(memory)), "a", "b", "n_units", "n_missed", "status")
    assert got[1, "fra_Latn"] == ("Bonjour. Ça va? Fine.", "Bonjour.", 4, 1, "miss")
    assert got[1, "zul_Latn"] == ("Sawubona. How are you? Fine.", "Sawubona.", 4, 2, "miss")
    assert got[5, "fra_Latn"][0] == "Bonjour. Bonjour. Bonjour."
    whole = by_key(translate(texts, ["a"], TARGETS, MemoryBackend(memory), WHOLE_TEXTS), "a", "n_missed")
    assert whole[5, "fra_Latn"] == ("Whole.", 0)
    strict = by_key(translate(texts, ["a"], TARGETS, MemoryBackend(memory, keep_missing=False)), "a", "status")
    assert strict[1, "fra_Latn"] == (None, "failed")
    assert strict[5, "fra_Latn"] == ("Bonjour. Bonjour. Bonjour.", "ok")


def test_lexicon_translates_words(spark, texts):
    words = spark.createDataFrame(
        [("eng_Latn", "fra_Latn", "good", "bon", 1.0), ("eng_Latn", "fra_Latn", "day.", "jour.", 1.0)], COLUMNS
    )
    got = by_key(translate(texts, ["a"], ["fra_Latn"], LexiconBackend(words)), "a", "n_units", "n_missed")
    assert got[1, "fra_Latn"] == ("bon jour. How are you? Fine.", 6, 4)


def test_more_targets_than_fit_one_block(spark, texts, memory):
    many = [f"t{i:02d}" for i in range(37)]
    rows = [("eng_Latn", t, "Good day.", f"{t}!", 1.0) for t in many]
    got = by_key(translate(texts, ["a"], many, MemoryBackend(spark.createDataFrame(rows, COLUMNS))), "a")
    assert len(got) == len(TEXTS) * 37
    assert all(got[5, t] == (f"{t}! {t}! {t}!",) for t in many)
    assert all(got[4, t] == ("Bonjour. Ça va?",) for t in many)
    tagged = translate(texts, ["a"], many, TAG, rebalance=["note"])
    assert {k: v for k, v in by_key(tagged, "a").items()}[5, "t36"] == ("<t36> Good day. <t36> Good day. <t36> Good day.",)


def test_identity_gives_the_text_back(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("row_id"), F.lit("eng_Latn").alias("source"), "text"
    )
    out = translate(docs, ["text"], ["fra_Latn"], IDENTITY).withColumnRenamed("text", "translated")
    squeezed = F.trim(F.regexp_replace("text", r"[ \n]+", " "))
    assert docs.join(out, "row_id").where(squeezed != F.col("translated")).count() == 0


def test_partitioning_does_not_matter(texts, memory):
    want = by_key(translate(texts, ["a", "b"], TARGETS, MemoryBackend(memory)), "a", "b", "n_missed")
    shuffled = texts.orderBy(F.desc("row_id")).repartition(7)
    assert by_key(translate(shuffled, ["a", "b"], TARGETS, MemoryBackend(memory)), "a", "b", "n_missed") == want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_units_give_the_same_result(spark, memory, adaptive):
    rows = [(i, "eng_Latn", "Good day." if i % 3 else f"Number {i}. Fine.") for i in range(600)]
    df = spark.createDataFrame(rows, "row_id long, source string, a string")
    hot = [spark.sql("select xxhash64('eng_Latn', 'Good day.')").first()[0]]
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = by_key(translate(df, ["a"], TARGETS, MemoryBackend(memory), hot=()), "a", "n_missed")
        salted = by_key(translate(df, ["a"], TARGETS, MemoryBackend(memory), hot=hot), "a", "n_missed")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plain == salted and len(plain) == 1200


def test_hot_keys_are_found(spark, monkeypatch):
    import glossaflow.operators.skew as skew

    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 1)
    monkeypatch.setattr(skew, "MIN_HOT_SHARE", 0.05)
    df = spark.range(20_000).select(
        F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("text"),
    )
    want = df.where("text = 'hot'").select(key_hash(["source", "text"]).alias("h")).first()["h"]
    assert hot_keys(df, lambda rows: rows, ["source", "text"], sample=0.5) == [want]


def test_salted_rows_of_a_hot_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(1000).select("id", F.lit("s").alias("source"), F.lit("hot").alias("text"))
        absent = F.when(F.col("id") < 0, "x").alias("text")  # a constant null would be optimized away
        nulls = spark.range(1000, 2000).select("id", F.lit("s").alias("source"), absent)
        right = hashed(spark.createDataFrame([("s", "hot", "x")], "source string, text string, v string"), ["source", "text"])
        hot = [left.select(key_hash(["source", "text"]).alias("h")).first()["h"]]
        joined = lookup_join(left.union(nulls), right, ["source", "text"], F.xxhash64("id"), hot)
        sizes = joined.groupBy(F.spark_partition_id().alias("p"), F.col("v").isNull().alias("miss")).count().collect()
        hits = [r["count"] for r in sizes if not r["miss"]]
        misses = [r["count"] for r in sizes if r["miss"]]
        assert sum(hits) == 1000 and len(hits) > 8 and max(hits) < 400
        assert sum(misses) == 1000 and len(misses) > 8 and max(misses) < 400
        # without hot keys, rows without a text are spread as well
        joined = lookup_join(nulls, right, ["source", "text"], F.xxhash64("id"))
        assert joined.groupBy(F.spark_partition_id()).count().count() > 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_best_candidate_breaks_ties_by_text(spark):
    rows = [("s", "t", "x", "b", 0.5), ("s", "t", "x", "a", 0.5), ("s", "t", "x", None, 0.9), ("s", "t", "y", "c", 0.1)]
    best = best_candidates(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {(r["text"], r["translation"]) for r in best} == {("x", "b"), ("y", "c")}


def test_function_is_called_once_per_distinct_unit(spark, texts):
    units = explode_units(texts, ["a"], SENTENCES).select("source", "text")
    answers = translate_units(units, TARGETS, FunctionBackend(lambda: marking)).collect()
    pairs = [(r["source"], r["target"], r["text"]) for r in answers]
    assert len(pairs) == len(set(pairs)) == 3 * 2 + 2
    assert {r["text"]: r["n_rows"] for r in answers}["Good day."] == 4


def test_stored_answers_are_not_asked_again(spark, texts):
    store = f"{scratch_folder(spark)}/store"
    assert read_store(spark, store) is None
    first = texts.where("row_id = 1")

    def refuse_known():
        def call(source, target, sentences):
            if "Good day." in sentences:
                raise RuntimeError("asked again")
            return [f"{target}:{s}" for s in sentences]

        return call

    translate(first, ["a"], TARGETS, FunctionBackend(lambda: marking), store=store).collect()
    strict = FunctionBackend(refuse_known, max_tries=1)
    got = by_key(translate(texts, ["a"], TARGETS, strict, store=store), "a", "status")
    assert got[5, "zul_Latn"] == ("zul_Latn:Good day. zul_Latn:Good day. zul_Latn:Good day.", "ok")
    assert got[4, "zul_Latn"] == ("zul_Latn:Bonjour. zul_Latn:Ça va?", "ok")
    rows = read_store(spark, store).groupBy("source", "target", "text").count().where("count > 1").count()
    assert rows == 0


def test_answers_given_before_a_job_failed_are_kept(spark):
    store = f"{scratch_folder(spark)}/store"
    units = spark.createDataFrame([("s", f"text {i}") for i in range(200)], "source string, text string")

    def breaking():
        def call(source, target, sentences):
            if "text 7" in sentences:
                time.sleep(5)
                return []
            return [f"{target}:{s}" for s in sentences]

        return call

    def second():
        def call(source, target, sentences):
            return [f"again:{s}" for s in sentences]

        return call

    with pytest.raises(Exception, match="0 translations"):
        translate_units(units, ["t"], FunctionBackend(breaking, parallelism=8), store)
    kept = read_store(spark, store).count()
    assert 0 < kept < 200
    answers = translate_units(units, ["t"], FunctionBackend(second, parallelism=8), store)
    assert answers.count() == answers.select("text").distinct().count() == 200
    assert answers.where("translation like 'again:%'").count() == 200 - kept


def test_a_long_word_list_takes_the_salted_join(spark, texts, memory, monkeypatch):
    import glossaflow.operators.skew as skew

    words = LexiconBackend(
        spark.createDataFrame([("eng_Latn", "fra_Latn", w, w[::-1], 1.0) for w in ("good", "how", "you?")], COLUMNS)
    )
    broadcast = translate(texts, ["a", "b"], TARGETS, words)
    want = by_key(broadcast, "a", "b", "n_missed")
    assert "BroadcastHashJoin [__hash" in plan_of(broadcast)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = translate(texts, ["a", "b"], TARGETS, words, hot=[spark.sql("select xxhash64('eng_Latn', 'good')").first()[0]])
        assert "SortMergeJoin [__hash" in plan_of(joined) and "__salt" in plan_of(joined)
        assert by_key(joined, "a", "b", "n_missed") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_columns_the_result_adds_must_be_free(texts):
    with pytest.raises(ValueError, match="status"):
        translate(texts.withColumn("status", F.lit("x")), ["a"], TARGETS, TAG)


def test_failed_units_make_the_text_null(texts):
    def load():
        def call(source, target, sentences):
            if target == "zul_Latn":
                raise RuntimeError("down")
            return marking(source, target, sentences)

        return call

    backend = FunctionBackend(load, max_tries=2, retry_wait=(0.0, 0.0))
    got = by_key(translate(texts, ["a"], TARGETS, backend), "a", "status", "n_missed")
    assert got[1, "zul_Latn"] == (None, "failed", 3)
    assert got[1, "fra_Latn"][1:] == ("ok", 0)
    assert got[3, "zul_Latn"] == ("", "ok", 0)


def test_one_text_as_a_one_row_frame(spark):
    one = spark.createDataFrame([(0, "eng_Latn", "Hello there. Bye.")], "row_id long, source string, text string")
    row = translate(one, ["text"], ["arz_Arab"], TAG).first()
    assert row["text"] == "<arz_Arab> Hello there. <arz_Arab> Bye."


@pytest.mark.parametrize("name", ["tag", "memory", "lexicon", "function"])
def test_rows_of_unknown_language_are_translated_too(spark, memory, name):
    df = spark.createDataFrame([(1, None, "Good day."), (2, "fra_Latn", "Bonjour.")], "row_id long, source string, a string")
    out = by_key(translate(df, ["a"], TARGETS, backends(memory)[name]), "source", "a", "status")
    assert len(out) == 4
    assert out[1, "fra_Latn"][0] == "und" and out[1, "fra_Latn"][2] in ("ok", "miss")
    if name == "function":
        assert out[1, "zul_Latn"] == ("und", "zul_Latn:Good day.", "ok")


def test_no_targets_is_an_error(texts):
    with pytest.raises(ValueError):
        translate(texts, ["a"], [], TAG)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf_dir, memory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("row_id"), F.lit("eng_Latn").alias("source"), "text"
    )
    native = plan_of(translate(docs, ["text"], TARGETS, TAG))
    assert "Exchange" not in native and "Python" not in native and "Cartesian" not in native
    assert "NestedLoop" not in native
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in native
    lookup = plan_of(translate(docs, ["text"], TARGETS, MemoryBackend(memory), copy_own_language=False, hot=()))
    # the texts were read and cut once, before: the plan reads the cut table (ids, then rows) and the reduced memory
    assert "struct<doc_id:bigint,text:string>" not in lookup and lookup.count("FileScan parquet") == 3
    exchanges = [line for line in lookup.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text" in line for line in exchanges)
    fan_out = lookup[:lookup.index("Generate inline")]
    assert "__hits" not in fan_out and "__found" not in fan_out
    assert "Cartesian" not in lookup and "NestedLoop" not in lookup and "Python" not in lookup
    balanced = plan_of(translate(docs, ["text"], TARGETS, TAG, copy_own_language=False, rebalance=["source"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in balanced
    split = plan_of(docs.select(F.posexplode(split_sentences(F.col("text")))))
    assert "Exchange" not in split
