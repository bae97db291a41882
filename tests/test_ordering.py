from pyspark.sql import functions as F

from glossaflow.operators.ordering import batch_numbers, batch_plan, running_total, sentence_offsets


def rows(spark, n=1000):
    # one group holds nearly everything
    return spark.range(n).select(
        F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("split"),
        (F.col("id") * 7919 % n).alias("row_id"),
        (F.col("id") % 13).alias("n"),
    )


def expected(data):
    sums, seen = {}, {}
    for split, row_id, n in sorted(data):
        sums[split, row_id] = seen.get(split, 0)
        seen[split] = seen.get(split, 0) + n
    return sums


def test_running_total_by_brute_force(spark):
    df = rows(spark)
    data = [tuple(r) for r in df.collect()]
    got = {(r["split"], r["row_id"]): r["before"] for r in running_total(df, ["split"], ["row_id"], "n", "before").collect()}
    assert got == expected(data)


def test_offsets_start_at_zero_and_meet(spark):
    out = sentence_offsets(rows(spark), ["split"], ["row_id"], "n").collect()
    for split in ("small", "large"):
        spans = sorted((r["row_id"], r["start_pos"], r["end_pos"]) for r in out if r["split"] == split)
        assert spans[0][1] == 0
        assert all(a[2] == b[1] for a, b in zip(spans, spans[1:]))


def test_batches_hold_forty_rows(spark):
    out = batch_numbers(rows(spark).select("split", "row_id"), ["split"], ["row_id"], 40)
    sizes = {(r["split"], r["batch_id"]): r["count"] for r in out.groupBy("split", "batch_id").count().collect()}
    assert sum(sizes.values()) == 1000
    assert all(size == 40 for (split, b), size in sizes.items() if (split, b + 1) in sizes)
    first = out.where("batch_id = 0 and split = 'large'").agg(F.max("row_id")).first()[0]
    second = out.where("batch_id = 1 and split = 'large'").agg(F.min("row_id")).first()[0]
    assert first < second


def test_byte_limit_is_flagged(spark):
    df = spark.createDataFrame(
        [("a", i, "x" * (3000 if i < 4 else 1) + "é") for i in range(8)], "split string, row_id long, text string"
    )
    plan = {r["batch_id"]: r for r in batch_plan(df, "text", ["split"], ["row_id"], 4, 5000).collect()}
    assert (plan[0]["n_bytes"], plan[0]["over_limit"]) == (4 * 3002, True)
    assert (plan[1]["n_bytes"], plan[1]["over_limit"]) == (4 * 3, False)
