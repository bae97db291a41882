from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from glossaflow.operators.backends import TAG, MemoryBackend
from glossaflow.operators.translate import WHOLE_TEXTS
from glossaflow.operators.batching import FunctionBackend
from glossaflow.plans.corpus import run_metrics, translate_corpus, translate_text, translated_preview
from glossaflow.sources import sinks
from glossaflow.sources.sinks import RunLabels, export_splits, written_rows

LABELS = RunLabels("PIQA", "finish", "facebook/nllb-200-3.3B", date(2023, 4, 5))
ROWS = [
    (1, "train", "One. Two.", "Yes.", "dropped"),
    (2, "train", "Three.", None, "dropped"),
    (3, "validation", "Four.", "No.", "dropped"),
    (4, "test", "Five.", "So.", "dropped"),
]


@pytest.fixture
def data(spark):
    return spark.createDataFrame(ROWS, "row_id long, split string, inputs string, targets string, other string")


def run(data, folder, **options):
    options.setdefault("source_language", "English")
    options.setdefault("target_codes_wanted", ["fra_Latn", "eng_Latn", "zul_Latn", "fra_Latn"])
    options.setdefault("splits", ["train", "validation"])
    return translate_corpus(data, ["inputs", "targets"], LABELS, options.pop("backend", TAG), folder, **options)


def test_table_holds_translations_and_the_source_copy(data, tmp_path):
    done = run(data, f"{tmp_path}/out")
    got = {(r["row_id"], r["pair"]): r for r in done.table.collect()}
    pairs = {"eng_Latn_to_fra_Latn", "eng_Latn_to_zul_Latn"}
    assert set(got) == {(i, p) for i in (1, 2, 3) for p in pairs} | {(i, "eng_Latn_to_eng_Latn") for i in (1, 2, 3, 4)}
    assert got[1, "eng_Latn_to_zul_Latn"]["inputs"] == "<zul_Latn> One. <zul_Latn> Two."
    assert got[4, "eng_Latn_to_eng_Latn"]["inputs"] == "Five."
    assert got[2, "eng_Latn_to_fra_Latn"]["targets"] is None
    assert "other" not in done.table.columns
    assert done.totals == {"n_rows": 10, "n_units": 12, "n_missed": 0, "n_failed": 0}
    record = done.record().first()
    assert record["n_rows"] == 10 and record["seconds"] > 0 and record["path"] == f"{tmp_path}/out"
    leaf = "dataset=PIQA/pair=eng_Latn_to_fra_Latn/checkpoint=facebook-nllb-200-3.3B/template=finish/run_date=2023-04-05"
    assert Path(f"{tmp_path}/out/{leaf}/split=train").is_dir()
    metrics = {(r["pair"], r["split"]): (r["n_rows"], r["n_units"]) for r in run_metrics(done.table).collect()}
    assert metrics["eng_Latn_to_zul_Latn", "train"] == (2, 4)
    assert metrics["eng_Latn_to_eng_Latn", "test"] == (1, 0)


def test_a_second_run_replaces_only_its_leaves(data, tmp_path):
    run(data, f"{tmp_path}/out")
    run(data.withColumn("inputs", F.lit("New.")), f"{tmp_path}/out", target_codes_wanted=["fra_Latn"])
    again = run(data.where("row_id = 1"), f"{tmp_path}/out", target_codes_wanted=["zul_Latn"])
    texts = {(r["row_id"], r["pair"]): r["inputs"] for r in again.table.collect()}
    assert texts[1, "eng_Latn_to_fra_Latn"] == "<fra_Latn> New."
    assert texts[1, "eng_Latn_to_zul_Latn"] == "<zul_Latn> One. <zul_Latn> Two."
    assert (2, "eng_Latn_to_zul_Latn") not in texts


def test_export_has_one_folder_per_pair_and_split(spark, data, tmp_path):
    done = run(data, f"{tmp_path}/out", export_root=f"{tmp_path}/export")
    base = f"{tmp_path}/export/PIQA/eng_Latn_to_fra_Latn/facebook-nllb-200-3.3B/finish/2023-04-05"
    assert f"{base}/train.csv" in done.exported and f"{base}/train.jsonl" in done.exported
    assert len(done.exported) == (2 * 2 + 3) * 2
    rows = spark.read.json(f"{base}/train.jsonl").collect()
    assert {r["inputs"] for r in rows} == {"<fra_Latn> One. <fra_Latn> Two.", "<fra_Latn> Three."}
    assert set(rows[0].asDict()) == {"inputs", "targets"}


def jobs_of(spark, action):
    group = f"group-{action}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_export_is_one_job_per_format(spark, data, tmp_path):
    done = run(data, f"{tmp_path}/out", target_codes_wanted=None)
    exported, jobs = jobs_of(spark, lambda: export_splits(done.table, f"{tmp_path}/export", ["inputs", "targets"]))
    assert len(exported) == (118 * 2 + 3) * 2 and jobs == 2
    counted = written_rows(spark, exported, spark.createDataFrame([], "inputs string, targets string").schema)
    rows = {tuple(r["path"].split("/")[-6:]): r["n_rows"] for r in counted.collect()}
    assert len(rows) == len(exported) and sum(rows.values()) == 2 * done.table.count()


def test_a_repeated_export_replaces_only_its_leaves(spark, data, tmp_path):
    folder = f"{tmp_path}/export"
    first = run(data, f"{tmp_path}/one", export_root=folder)
    again = run(data.where("row_id = 1").withColumn("inputs", F.lit("New.")), f"{tmp_path}/two", target_codes_wanted=["fra_Latn"],
                export_root=folder)
    base = f"{folder}/PIQA/eng_Latn_to_%s/facebook-nllb-200-3.3B/finish/2023-04-05/%s.jsonl"
    texts = lambda pair, split: sorted(r["inputs"] for r in spark.read.json(base % (pair, split)).collect())
    assert texts("fra_Latn", "train") == ["<fra_Latn> New."]
    assert texts("fra_Latn", "validation") == ["<fra_Latn> Four."]
    assert texts("zul_Latn", "train") == ["<zul_Latn> One. <zul_Latn> Two.", "<zul_Latn> Three."]
    assert set(again.exported) < set(first.exported)
    assert sorted(p.name for p in Path(folder).iterdir()) == ["PIQA"]


def test_an_interrupted_export_can_be_finished(spark, data, tmp_path, monkeypatch):
    done = run(data, f"{tmp_path}/out")
    monkeypatch.setattr(sinks, "commit_leaves", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        export_splits(done.table, f"{tmp_path}/export", ["inputs"], ["json"])
    monkeypatch.undo()
    (staging,) = Path(f"{tmp_path}/export").iterdir()
    leaves = sinks.written_leaves(spark, str(staging))
    assert len(leaves) == 7
    paths = sinks.commit_leaves(spark, f"{tmp_path}/export", str(staging), "jsonl")
    assert len(paths) == 7 and not staging.exists() and all(Path(p).is_dir() for p in paths)


def test_names_that_need_escapes_in_paths(spark, tmp_path):
    table = spark.createDataFrame([("a: c", "x_to_y", "m", "100% = all", "2024-01-01", "train", "text")],
                                  "dataset string, pair string, checkpoint string, template string, run_date string, split string, text string")
    (path,) = export_splits(table, f"{tmp_path}/export", ["text"], ["csv"])
    assert path == f"{tmp_path}/export/a: c/x_to_y/m/100% = all/2024-01-01/train.csv"
    assert [p.name for p in Path(path).iterdir() if p.name.startswith("part")]


def test_lookup_backend_and_whole_texts(spark, data, tmp_path):
    memory = spark.createDataFrame(
        [("eng_Latn", "fra_Latn", "One. Two.", "Un. Deux.")], "source string, target string, text string, translation string"
    )
    done = run(data, f"{tmp_path}/out", backend=MemoryBackend(memory), cutting=WHOLE_TEXTS, target_codes_wanted=["fra_Latn"])
    texts = {(r["row_id"], r["pair"]): (r["inputs"], r["n_missed"]) for r in done.table.collect()}
    assert texts[1, "eng_Latn_to_fra_Latn"] == ("Un. Deux.", 1)
    assert texts[3, "eng_Latn_to_fra_Latn"] == ("Four.", 2)


def test_cloud_codes_by_backend_name(data, tmp_path):
    labels = RunLabels("PIQA", "finish", "google_cloud_translate", date(2023, 4, 5))
    done = translate_corpus(
        data, ["inputs"], labels, TAG, f"{tmp_path}/out", source_language="English", target_codes_wanted=["iw", "zh"],
        cutting=WHOLE_TEXTS,
    )
    assert {r["pair"] for r in done.table.select("pair").collect()} == {"en_to_he", "en_to_zh-CN", "en_to_en"}


def test_unknown_languages_are_refused_first(data, tmp_path):
    with pytest.raises(ValueError, match="Klingon"):
        run(data, f"{tmp_path}/out", source_language="Klingon")
    with pytest.raises(ValueError, match="tlh_Latn"):
        run(data, f"{tmp_path}/out", target_codes_wanted=["tlh_Latn"])
    with pytest.raises(ValueError, match="source"):
        run(data, f"{tmp_path}/out", source_language=None)
    assert not Path(f"{tmp_path}/out").exists()


def test_all_default_targets_in_one_job(data, tmp_path):
    done = run(data, f"{tmp_path}/out", target_codes_wanted=None, splits=["validation"])
    assert done.table.where("split = 'validation'").select("pair").distinct().count() == 119


def test_names_of_languages(spark, data, tmp_path):
    named = data.withColumn("language", F.when(F.col("row_id") == 1, "French").when(F.col("row_id") == 2, "German"))
    done = run(named, f"{tmp_path}/out", source_language=None, source_name_column="language", target_codes_wanted=None,
               target_names_wanted=["Zulu", "French"])
    pairs = {(r["row_id"], r["pair"]) for r in done.table.collect()}
    assert {p for i, p in pairs if i == 1} == {"fra_Latn_to_zul_Latn", "fra_Latn_to_fra_Latn"}
    assert {p for i, p in pairs if i == 3} == {"und_to_zul_Latn", "und_to_fra_Latn", "und_to_und"}
    with pytest.raises(ValueError, match="Elvish, Klingon"):
        wrong = named.withColumn("language", F.when(F.col("row_id") == 1, "Klingon").when(F.col("row_id") == 2, "Elvish").otherwise("French"))
        run(wrong, f"{tmp_path}/none", source_language=None, source_name_column="language")
    with pytest.raises(ValueError, match="Klingon"):
        run(data, f"{tmp_path}/none", target_names_wanted=["Zulu", "Klingon"])
    assert not Path(f"{tmp_path}/none").exists()


def test_one_text_by_names(spark):
    assert translate_text(spark, "Hello there. Bye.", "English", "Zulu", TAG) == "<zul_Latn> Hello there. <zul_Latn> Bye."
    with pytest.raises(ValueError, match="Nowhere"):
        translate_text(spark, "x", "English", "Nowhere", TAG)


def test_time_per_split(data, tmp_path):
    def load():
        def call(source, target, texts):
            return texts

        return call

    for backend in (TAG, FunctionBackend(load)):
        done = run(data, f"{tmp_path}/{backend.name}", backend=backend)
        assert set(done.split_seconds) == {"train", "validation", "test"}
        assert all(0 <= s <= done.seconds for s in done.split_seconds.values())
        assert done.totals["n_rows"] == done.table.count()


def test_preview_translates_one_row_per_split(spark, data, tmp_path):
    log = str(tmp_path / "sent")

    def load():
        def call(source, target, texts):
            with open(log, "a") as file:
                file.writelines(f"{text}\n" for text in texts)
            return [f"{target}: {text}" for text in texts]

        return call

    rows = data.withColumn("source", F.lit("eng_Latn"))
    shown = translated_preview(rows, ["inputs"], ["zul_Latn"], FunctionBackend(load)).collect()
    assert {(r["split"], r["row_id"], r["inputs"]) for r in shown} == {
        ("train", 1, "zul_Latn: One. zul_Latn: Two."), ("validation", 3, "zul_Latn: Four."), ("test", 4, "zul_Latn: Five.")}
    assert sorted(open(log).read().split()) == ["Five.", "Four.", "One.", "Two."]
