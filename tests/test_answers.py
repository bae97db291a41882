"""Answers of a function to each distinct text, in one row for all targets of a block."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from glossaflow.operators.batching import FunctionBackend, answer_columns, answer_texts
from glossaflow.operators.translate import TARGETS_PER_BLOCK, translate, translate_units

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def numbered():
    """Answers that tell the call they came with, its size and its pair."""
    number = iter(range(10**6))

    def call(source, target, texts):
        n = next(number)
        if target == "down":
            raise RuntimeError("no model")
        return [f"{n}/{len(texts)}/{source}>{target}/{t}" for t in texts]

    return call


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    for module in ("scratch", "operators.translate"):
        monkeypatch.setattr(f"glossaflow.{module}.scratch_folder", lambda spark: str(tmp_path))
    return tmp_path


def test_calls_are_full_and_answers_stay_with_their_text(spark):
    """Record batches of 7 rows, two languages, two blocks of targets: all calls but the last ones have 16 texts."""
    rows = [("st"[i % 2], f"text {i}", i // 2 % 2, [i]) for i in range(1000)]
    df = spark.createDataFrame(rows, "source string, text string, __block int, ids array<int>").repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = answer_texts(df, [["t", "u"], ["v"]], FunctionBackend(numbered, batch_rows=16)).withColumn(
            "part", F.spark_partition_id()
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["source"], r["text"], r["__block"], r["ids"]) for r in got) == sorted(rows)
    sizes = {}
    for r in got:
        for slot, target in enumerate([["t", "u"], ["v", None]][r["__block"]]):
            answer = {name: r[c] for name, c in answer_columns(slot).items()}
            if target in (None, r["source"]):
                assert set(answer.values()) == {None}
                continue
            n, size, pair, text = answer.pop("translation").split("/")
            assert (pair, text) == (f"{r['source']}>{target}", r["text"])
            assert answer == {"status": "ok", "attempts": 1, "error": None}
            sizes.setdefault((r["part"], r["source"], target), {})[int(n)] = int(size)
    for calls in sizes.values():
        assert all(size == 16 for n, size in calls.items() if n != max(calls))


def test_byte_limit_of_calls(spark):
    def load():
        def call(source, target, texts):
            assert len(texts) == 1 or sum(map(len, texts)) <= 30
            return texts

        return call

    rows = [("s", "x" * (i % 40 + 1), 0) for i in range(200)]
    df = spark.createDataFrame(rows, "source string, text string, __block int").coalesce(1)
    out = answer_texts(df, [["t"]], FunctionBackend(load, batch_bytes=30, max_tries=1)).collect()
    assert sorted(r["__translation0"] for r in out) == sorted(text for _, text, _ in rows)
    assert {r["__status0"] for r in out} == {"ok"}


def test_answers_are_written_once_per_text_and_not_moved_again(spark, scratch):
    units = spark.createDataFrame([("s", f"text {i % 300}") for i in range(900)], "source string, text string")
    quick = FunctionBackend(numbered, batch_rows=50, retry_wait=(0.0, 0.0))
    answers = translate_units(units, ["t", "down", "s", "t"], quick)
    plan = answers._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    table = spark.read.parquet(str(next(scratch.glob("translations"))))
    assert table.count() == 300
    assert all(".zstd." in f.name for f in scratch.glob("translations/part-*"))
    got = answers.collect()
    assert sorted((r["target"], r["text"]) for r in got) == sorted((t, f"text {i}") for t in ("t", "down") for i in range(300))
    assert all(r["n_rows"] == 3 and r["source"] == "s" for r in got)
    for r in got:
        if r["target"] == "down":
            assert (r["translation"], r["status"], r["attempts"], r["error"]) == (None, "failed", 5, "RuntimeError: no model")
        else:
            assert r["translation"].endswith(f"s>t/{r['text']}") and (r["status"], r["attempts"], r["error"]) == ("ok", 1, None)


def test_units_of_more_targets_than_one_block(spark):
    targets = [f"t{i}" for i in range(TARGETS_PER_BLOCK + 3)]
    units = spark.createDataFrame([("s", "a"), (None, "b"), ("t17", "c"), ("t17", None)], "source string, text string")
    got = {(r["source"], r["target"], r["text"], r["translation"].split("/")[2]) for r in translate_units(
        units, targets, FunctionBackend(numbered)
    ).collect()}
    known = [("s", "a"), ("und", "b"), ("t17", "c")]
    assert got == {(s, t, x, f"{s}>{t}") for s, x in known for t in targets if t != s}


def marked(source, target, texts):
    if target == "down":
        raise RuntimeError("no model")
    return [None if t == "Odd." and target == "t3" else f"{source}>{target}: {t}" for t in texts]


ROWS = [
    (i, ["en", "t2", None][i % 3], f"note {i}", a, b)
    for i, (a, b) in enumerate([
        ("Good day. How are you? Fine.", "Good day."), (None, "Short"), ("", " \n "), ("Fine. Odd.", None),
        ("Good day. Good day. Good day.", "Fine."), (None, None), *[(f"Good day. Number {i % 4}.", "Good day.") for i in range(30)],
    ])
]


def by_hand(rows, targets):
    """One row per row and target, sentence by sentence."""
    made = {}
    for i, source, note, a, b in rows:
        source = source or "und"
        for target in targets:
            if source == target:
                made[i, target] = (source, note, a, b, 0, 0, "copied")
                continue
            cut = [[f"{s}." if not s.endswith("Short") else s for s in text.replace("?", "?.").split(".") if s.strip()]
                   if text is not None else [] for text in (a, b)]
            cut = [[s.strip().replace("?.", "?") for s in one] for one in cut]
            found = [[None if target == "down" else marked(source, target, [s])[0] for s in one] for one in cut]
            n_missed = sum(f is None for one in found for f in one)
            texts = [None if text is None or None in one else " ".join(one) for text, one in zip((a, b), found)]
            made[i, target] = (source, note, *texts, sum(map(len, cut)), n_missed, "failed" if n_missed else "ok")
    return made


@pytest.mark.parametrize("way", ["one part", "parts", "hot", "store"])
@pytest.mark.parametrize("n_targets", [4, TARGETS_PER_BLOCK + 3])
def test_translations_go_back_to_their_texts(spark, scratch, monkeypatch, way, n_targets):
    targets = ["down", *[f"t{i}" for i in range(1, n_targets)]]
    df = spark.createDataFrame(ROWS, "row_id long, source string, note string, a string, b string").repartition(3)
    if way in ("parts", "hot"):
        monkeypatch.setattr("glossaflow.operators.translate.MIN_HOT_ROWS", 1)
    hot = None
    if way == "hot":
        hot = [r[0] for r in spark.range(1).selectExpr(
            "explode(array(xxhash64('en', 'Good day.'), xxhash64('und', 'Fine.'), xxhash64('xx', 'y')))").collect()]
    backend = FunctionBackend(lambda: marked, batch_rows=5, max_tries=1, give_up_after=2)
    out = translate(df, ["a", "b"], targets, backend, hot=hot, store=f"{scratch}/store" if way == "store" else None)
    got = {}
    for r in out.collect():
        assert (r["row_id"], r["target"]) not in got
        got[r["row_id"], r["target"]] = tuple(r[c] for c in ("source", "note", "a", "b", "n_units", "n_missed", "status"))
    assert got == by_hand(ROWS, targets)


def test_finished_texts_wait_in_one_table(spark, scratch, monkeypatch):
    """Units, answers and shuffles are gone before the result is read, and a hot unit is asked once."""
    monkeypatch.setattr("glossaflow.operators.translate.MIN_HOT_ROWS", 1)
    df = spark.createDataFrame([(i, "s", f"Good day. Number {i}.") for i in range(200)], "row_id long, source string, text string")

    def once():
        def call(source, target, texts):
            assert len(texts) == len(set(texts))
            return [f"{target}: {t}" for t in texts]

        return call

    hot = [spark.range(1).selectExpr("xxhash64('s', 'Good day.')").first()[0]]
    out = translate(df, ["text"], ["s", "t", "u"], FunctionBackend(once), hot=hot)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted(f.name for f in scratch.iterdir()) == ["ready", "rows"]
    got = {(r["row_id"], r["target"]): r["text"] for r in out.collect()}
    assert got == {
        (i, t): f"Good day. Number {i}." if t == "s" else f"{t}: Good day. {t}: Number {i}." for i in range(200) for t in "stu"
    }
