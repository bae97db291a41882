"""What the join leaves behind: on disk only what its result reads, in the workers no words."""

import sys

import pyarrow as pa

from glossaflow import scratch
from glossaflow.llm import jaccard_join
from test_jaccard_join import brute_force, texts


def test_disk_and_memory_are_given_back(spark, monkeypatch, tmp_path):
    rows, switched, write = texts(), set(), jaccard_join.stage

    def watched(df, name, folder=None):
        switched.add(spark.conf.get(scratch.SHUFFLE_CLEANUP_SETTING))
        return write(df, name, folder)

    monkeypatch.setattr(jaccard_join, "scratch_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(jaccard_join, "stage", watched)
    before = spark.conf.get(scratch.SHUFFLE_CLEANUP_SETTING)
    found = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90, 100)
    kinds = {path.name.split("_")[0].rstrip("0123456789") for path in tmp_path.iterdir()}
    assert kinds <= {"members", "named", "classes", "of", "links"}, kinds
    assert switched == {"true"} and spark.conf.get(scratch.SHUFFLE_CLEANUP_SETTING) == before
    assert sorted(tuple(r)[:3] for r in found.collect()) == brute_force(rows, 3, 90, 100)

    def remembered(batches):
        for _ in batches:
            held = getattr(sys.modules.get("_worker_state"), "held", {})
            yield pa.RecordBatch.from_arrays([pa.array([len(held["jaccard"][1]) if "jaccard" in held else 0])], ["n"])

    kept = spark.range(0, 64, 1, 16).mapInArrow(remembered, "n long")
    assert {r["n"] for r in kept.collect()} == {0}
