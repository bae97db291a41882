"""Stages of the pipeline hand whole rows to workers in small batches, also when the caller writes what they return."""

import pyarrow as pa

import corpus_pipeline
from glossaflow import scratch
from glossaflow.llm import decontamination

SF = "/root/testdata/sf0.001"
SCAN, WORKERS = scratch.BATCH_SETTINGS


def test_rows_reach_decontamination_in_small_batches(spark, monkeypatch):
    def counted(df, function, schema, column="text"):
        """In place of the operator's map: how many rows each batch has."""
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

        return df.mapInArrow(run, "n long")

    monkeypatch.setattr(decontamination, "map_batches", counted)
    before = {name: spark.conf.get(name) for name in scratch.BATCH_SETTINGS}
    try:
        for name in scratch.BATCH_SETTINGS:
            spark.conf.set(name, "4096")
        docs = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "'some text of a row' as text")
        sizes = [r["n"] for r in corpus_pipeline.without_benchmark(spark, docs, SF).collect()]
        assert sum(sizes) == 2000 and max(sizes) <= scratch.BATCH_ROWS
    finally:
        for name, rows in before.items():
            spark.conf.set(name, rows)


def test_run_sets_the_session_back(spark, monkeypatch):
    before, seen = (spark.conf.get(SCAN), spark.conf.get(WORKERS)), []

    def one(spark, docs, sf_dir):
        scratch.take_small_batches(spark)
        seen.append(int(spark.conf.get(WORKERS)))
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", one), ("two", one)])
    corpus_pipeline.run(spark, SF)
    assert len(seen) == 2 and max(seen) <= scratch.BATCH_ROWS
    assert (spark.conf.get(SCAN), spark.conf.get(WORKERS)) == before
