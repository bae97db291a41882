import json
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from glossaflow.scratch import CHECKPOINT_SETTING, scratch_folder, stage
from glossaflow.sources import sinks, splits

TRICKY = [
    (1, "a\nb"),
    (2, 'say "hi", he said'),
    (3, "back\\slash \\n"),
    (4, "  leading and trailing  "),
    (5, ""),
    (6, None),
    (7, "日本語 – ελληνικά"),
    (8, "comma, semi; tab\t."),
]
SCHEMA = "row_id long, text string"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_keeps_text(spark, folder):
    df = spark.createDataFrame(TRICKY, SCHEMA)
    sinks.write_csv(df, f"{folder}/t.csv")
    back = dict(rows_of(sinks.read_csv(spark, f"{folder}/t.csv", SCHEMA)))
    want = {k: (v if v != "" else None) for k, v in TRICKY}  # CSV cannot tell empty from null
    assert {k: v or None for k, v in back.items()} == want


def test_jsonl_keeps_everything(spark, folder):
    df = spark.createDataFrame(TRICKY, SCHEMA)
    sinks.write_jsonl(df, f"{folder}/t.jsonl")
    assert dict(tuple(r) for r in sinks.read_jsonl(spark, f"{folder}/t.jsonl", SCHEMA).collect()) == dict(TRICKY)
    lines = [json.loads(line) for f in Path(folder).glob("t.jsonl/part-*") for line in open(f, encoding="utf8")]
    assert {"row_id": 6, "text": None} in lines


def write_lines(path, objects):
    Path(path).write_text("".join(json.dumps(o) + "\n" for o in objects), encoding="utf8")


def test_several_files_per_split(spark, folder):
    write_lines(f"{folder}/a.jsonl", [{"inputs": "a", "targets": "1", "extra": 1}])
    write_lines(f"{folder}/b.jsonl", [{"inputs": "b", "targets": "2"}])
    write_lines(f"{folder}/c.jsonl", [{"inputs": "c", "targets": "3"}])
    df = splits.read_splits(
        spark, {"train": [f"{folder}/a.jsonl", f"{folder}/b.jsonl"], "validation": [f"{folder}/c.jsonl"], "test": []}
    )
    assert {(r["split"], r["inputs"]) for r in df.collect()} == {("train", "a"), ("train", "b"), ("validation", "c")}
    kept = splits.keep_translate_columns(df, ["inputs", "targets"])
    assert kept.columns == ["split", "inputs", "targets"]
    assert rows_of(splits.split_counts(df)) == [("train", 2), ("validation", 1)]
    assert splits.select_splits(df, ["train"]).count() == 2


def test_schema_and_options_are_passed_on(spark, folder):
    Path(f"{folder}/x.csv").write_text("inputs;n\nhello;1\n", encoding="utf8")
    df = splits.read_splits(
        spark, {"test": [f"{folder}/x.csv"]}, "csv", schema="inputs string, n int", options={"sep": ";", "header": "true"}
    )
    assert [tuple(r) for r in df.collect()] == [("hello", 1, "test")]


def test_no_files_is_an_error(spark):
    with pytest.raises(ValueError, match="split"):
        splits.read_splits(spark, {"train": [], "validation": [], "test": []})


def test_unknown_key_is_an_error(spark):
    with pytest.raises(ValueError, match="nope"):
        splits.keep_translate_columns(spark.range(1), ["nope"])


def test_named_table(spark):
    spark.createDataFrame([("a", "train")], "text string, part string").createOrReplaceTempView("named_data")
    assert splits.read_named(spark, "named_data", "part").columns == ["text", "split"]


def test_row_ids_are_fixed_once_assigned(spark):
    df = splits.assign_row_ids(spark.range(100).select(F.rand().alias("r")).repartition(5))
    first = {(r["row_id"], r["r"]) for r in df.collect()}
    assert len({i for i, _ in first}) == 100
    assert first == {(r["row_id"], r["r"]) for r in df.collect()}


def test_preview_is_the_first_row(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "split string, row_id long, text string")
    assert rows_of(splits.split_preview(df)) == [("a", 1, "y"), ("b", 2, "z")]  # columns as given


def test_layout_of_paths(spark):
    labels = sinks.RunLabels("PIQA", "finish", "facebook/nllb-200-3.3B", date(2023, 4, 5))
    df = spark.createDataFrame([("eng_Latn", "arz_Arab", "train")], "source string, target string, split string")
    path = sinks.label(df, labels).select(sinks.split_path("out", "jsonl")).first()[0]
    assert path == "out/PIQA/eng_Latn_to_arz_Arab/facebook-nllb-200-3.3B/finish/2023-04-05/train.jsonl"


class Session:
    """The settings a scratch folder depends on."""

    def __init__(self, setting, context_dir, master):
        self.conf = {CHECKPOINT_SETTING: setting} if setting else {}
        self.sparkContext = SimpleNamespace(getCheckpointDir=lambda: context_dir, master=master)


def test_scratch_follows_the_session(spark):
    assert scratch_folder(Session("hdfs://shared/cp/", "hdfs://other", "yarn")).startswith("hdfs://shared/cp/glossaflow/")
    assert scratch_folder(Session(None, "hdfs://other", "yarn")).startswith("hdfs://other/glossaflow/")
    with pytest.raises(ValueError, match=CHECKPOINT_SETTING):
        scratch_folder(Session(None, None, "yarn"))
    assert "glossaflow" in scratch_folder(Session(None, None, "local[2]"))
    assert scratch_folder(spark) != scratch_folder(spark)
    assert stage(spark.range(5), "numbers").count() == 5
