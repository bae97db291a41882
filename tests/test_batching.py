import pytest
from pyspark.sql import functions as F

from glossaflow.operators.batching import (
    FunctionBackend,
    apply_function,
    batched_map,
    call_in_parts,
    call_with_retry,
    cut_batches,
    remote_function,
)


def test_batches_keep_both_limits():
    assert list(cut_batches([], 40, 100)) == []
    assert list(cut_batches([0, 0], 40, 100)) == [(0, 2)]
    assert list(cut_batches([1] * 85, 40, 100)) == [(0, 40), (40, 80), (80, 85)]
    assert list(cut_batches([60, 60, 10], 40, 100)) == [(0, 1), (1, 3)]
    assert list(cut_batches([5, 500, 5], 40, 100)) == [(0, 1), (1, 2), (2, 3)]
    sizes = [(i * 37) % 90 for i in range(500)]
    cuts = list(cut_batches(sizes, 7, 200))
    assert [i for start, end in cuts for i in range(start, end)] == list(range(500))
    assert all(end - start <= 7 and sum(sizes[start:end]) <= 200 for start, end in cuts)


class Clock:
    def __init__(self):
        self.waits = []

    def __call__(self, seconds):
        self.waits.append(seconds)


def failing(times):
    left = [times]

    def call(source, target, texts):
        if left[0] > 0:
            left[0] -= 1
            raise ConnectionError("busy")
        return [t.upper() for t in texts]

    return call


@pytest.mark.parametrize("times,want", [(0, 1), (1, 2), (4, 5)])
def test_retry_stops_at_the_first_success(times, want):
    clock = Clock()
    backend = FunctionBackend(None, pause=(0.8, 1.5), sleep=clock)
    answer = call_with_retry(backend, failing(times), "a", "b", ["x", "y"])
    assert answer == (["X", "Y"], "ok", want, None)
    assert len(clock.waits) == times + 1
    assert all(2 <= w <= 5 for w in clock.waits[:-1]) and 0.8 <= clock.waits[-1] <= 1.5


def test_retry_gives_up_and_says_so():
    clock = Clock()
    answer = call_with_retry(FunctionBackend(None, sleep=clock), failing(99), "a", "b", ["x"])
    assert answer == ([None], "failed", 5, "ConnectionError: busy")
    assert len(clock.waits) == 4


def test_wrong_number_of_answers_raises():
    with pytest.raises(ValueError, match="1 translations for 2"):
        call_with_retry(FunctionBackend(None), lambda s, t, texts: ["x"], "a", "b", ["x", "y"])


def test_wrong_number_of_answers_ends_the_job(spark):
    df = spark.createDataFrame([("s", "t", "a"), ("s", "t", "b")], "source string, target string, text string").coalesce(1)
    with pytest.raises(Exception, match="translations for 2 texts"):
        apply_function(df, FunctionBackend(lambda: lambda s, t, texts: ["x"])).collect()


def test_calls_see_one_pair_and_no_nulls(spark):
    rows = [("en", ["fr", "zu"][i % 2], None if i % 10 == 0 else f"text {i}", i) for i in range(200)]

    def load():
        def call(source, target, texts):
            assert None not in texts and len(texts) <= 16
            return [f"{target}|{len(texts)}|{t}" for t in texts]

        return call

    df = spark.createDataFrame(rows, "source string, target string, text string, id long").repartition(3)
    out = apply_function(df, FunctionBackend(load, batch_rows=16)).collect()
    assert len(out) == 200
    for row in out:
        if row["text"] is None:
            assert row["translation"] is None and row["attempts"] == 0
        else:
            target, n, text = row["translation"].split("|")
            assert (target, text, row["status"]) == (row["target"], row["text"], "ok") and 1 <= int(n) <= 16


def test_batch_size_changes_nothing(spark):
    df = spark.createDataFrame([("s", "t", f"w{i}") for i in range(100)], "source string, target string, text string")
    results = []
    for rows, size in ((1, 10), (7, 1000), (1000, 10**9)):
        backend = FunctionBackend(lambda: lambda s, t, texts: [x[::-1] for x in texts], batch_rows=rows, batch_bytes=size)
        results.append({(r["text"], r["translation"]) for r in apply_function(df, backend).collect()})
    assert results[0] == results[1] == results[2] and len(results[0]) == 100


def test_remote_function_sends_the_request_body():
    sent = []

    def post(body):
        sent.append(body)
        return {"translated_texts": [t + "!" for t in body["texts"]]}

    assert remote_function(post)("eng_Latn", "arz_Arab", ["a", "b"]) == ["a!", "b!"]
    assert sent == [{"source_language": "eng_Latn", "target_language": "arz_Arab", "texts": ["a", "b"]}]


def test_batched_map_gives_column_batches(spark):
    df = spark.range(0, 1000, numPartitions=3).selectExpr("id", "cast(id as string) as text")

    def size(batch):
        assert len(batch["id"]) <= 40
        return {"id": batch["id"], "text": [f"{t}/{len(batch['id'])}" for t in batch["text"]]}

    out = batched_map(df, size, batch_size=40).collect()
    assert sorted(r["id"] for r in out) == list(range(1000))
    assert all(int(r["text"].split("/")[1]) <= 40 for r in out)


def poisoned(bad, calls):
    def call(source, target, texts):
        calls.append(len(texts))
        if any(t in bad for t in texts):
            raise ValueError("bad text")
        return [t.upper() for t in texts]

    return call


def quick(**options):
    return FunctionBackend(None, sleep=lambda seconds: None, **options)


@pytest.mark.parametrize("bad", [[0], [999], [500], [0, 1], [3, 400, 401, 998]])
def test_a_bad_text_costs_only_itself(bad):
    texts, calls = [f"t{i}" for i in range(1000)], []
    found = call_in_parts(quick(), poisoned({texts[i] for i in bad}, calls), "a", "b", texts)
    assert [i for i, r in enumerate(found) if r[1] == "failed"] == bad
    assert all(r == (t.upper(), "ok", 1, None) for i, (t, r) in enumerate(zip(texts, found)) if i not in bad)
    assert all(found[i] == (None, "failed", 5, "ValueError: bad text") for i in bad)
    # five tries for the whole, one call per part, five tries for a text alone
    assert len(calls) <= 5 + len(bad) * (2 * 10 + 5)


def test_a_backend_that_is_down_is_not_asked_for_every_text():
    texts, calls = [f"t{i}" for i in range(1000)], []
    found = call_in_parts(quick(), poisoned(set(texts), calls), "a", "b", texts)
    assert {r[1:] for r in found} == {("failed", 5, "ValueError: bad text")}
    assert len(calls) <= 5 + 17


def test_a_part_that_answers_wrongly_raises():
    def call(source, target, texts):
        if len(texts) > 2:
            raise ValueError("too many")
        return []

    with pytest.raises(ValueError, match="0 translations for 2"):
        call_in_parts(quick(), call, "a", "b", ["x"] * 4)


def test_calls_are_full_across_record_batches(spark):
    """1,000 rows in two pairs, in record batches of 7 rows: every call but the last of a pair and task has 16 texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [("s", "tu"[i % 2], None if i % 50 == 0 else f"text {i}", i) for i in range(1000)]
        df = spark.createDataFrame(rows, "source string, target string, text string, id long").repartition(2)

        def load():
            number = iter(range(10**6))

            def call(source, target, texts):
                n = next(number)
                return [f"{n}/{len(texts)}/{t}" for t in texts]

            return call

        out = apply_function(df, FunctionBackend(load, batch_rows=16)).withColumn("part", F.spark_partition_id())
        assert "Sort" not in out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["id"], r["source"], r["target"], r["text"]) for r in got) == sorted((i, s, t, x) for s, t, x, i in rows)
    sizes = {}
    for r in got:
        if r["text"] is None:
            assert r["translation"] is None and r["attempts"] == 0
            continue
        n, size, text = r["translation"].split("/", 2)
        assert text == r["text"]
        sizes.setdefault((r["part"], r["target"]), {})[int(n)] = int(size)
    for calls in sizes.values():
        assert all(size == 16 for n, size in calls.items() if n != max(calls))


def test_byte_limit_across_record_batches(spark):
    df = spark.createDataFrame([("s", "t", "x" * (i % 40 + 1)) for i in range(200)], "source string, target string, text string")

    def load():
        def call(source, target, texts):
            assert len(texts) == 1 or sum(map(len, texts)) <= 30
            return texts

        return call

    out = apply_function(df.coalesce(1), FunctionBackend(load, batch_bytes=30, max_tries=1)).collect()
    assert all(r["translation"] == r["text"] and r["status"] == "ok" for r in out) and len(out) == 200
