"""Names of shards without files, and counts of a text that holds half of all rows."""

import public_tokenizers
import pytest

from glossaflow.llm import packing, token_counts


def test_shards_of_different_tasks_have_different_names(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(40)], "doc_id long, text string")
    packed = packing.pack(docs.repartition(4), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          row_length=64, shard_tokens=50)
    rows = [(r["shard"], r["row"]) for r in packed.collect()]
    assert len(rows) == len(set(rows)) > 4


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_frequent_text_is_split_over_tasks(spark, tmp_path):
    docs = spark.range(20000).selectExpr("id as doc_id", "if(id % 2 = 0, 'the same text', concat('text ', id)) as text")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = token_counts.count_tokens(docs.repartition(8), public_tokenizers.path("piece_bpe_32k.model"),
                                          str(tmp_path / "cache"))
        assert found.where("n_tokens is null").count() == 0
        found.write.format("noop").mode("overwrite").save()
        rows = found.collect()
        plan = plan_of(found)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) == 20000 and len({r["n_tokens"] for r in rows if r["doc_id"] % 2 == 0}) == 1
    assert "skew=true" in plan


def test_a_cache_that_cannot_be_read_is_an_error(spark, tmp_path):
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "part-0.parquet").write_text("no table")
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(Exception):
        token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), str(tmp_path / "cache")).collect()
