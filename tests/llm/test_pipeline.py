"""The stages of the pipeline, each on what the one before kept, against brute force."""

import re

import base64
import public_tokenizers
import tiktoken

import __spark_entry__ as entry_points
import corpus_pipeline
from glossaflow.scratch import stage
from test_jaccard_join import brute_force

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, columns = [set(given)], docs.columns
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), name)
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert docs.count() == len(rows) and set(rows) <= kept[-1]
        assert all(rows[i][c] == given[i][c] for i in rows for c in columns)
        kept.append(set(rows))
        if name != "byte_bpe":
            assert docs.columns == columns
    everything, language, clean, single, unleaked, coded = kept
    assert len(language) >= 0.97 * len(everything)
    assert sum(labels.get(i) == 0 for i in language - clean) <= 2  # clean documents stay
    classes = brute_force([(i, given[i]["text"]) for i in sorted(clean)], 5, 8, 10)
    assert single == {i for i, n, least in classes if i == least or n == 0}
    wording = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [wording(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i in single if any(item in wording(given[i]["text"]) for item in items)}
    assert single - unleaked == whole and coded == unleaked
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r["token_ids"] == library.encode_ordinary(r["text"] or "") for r in rows.values())


def test_queries_are_registered():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in entry_points.queries()) if m)
    assert numbers == list(range(1, 14)) and "pipeline" in entry_points.queries()


def test_nothing_else_imports_the_operators():
    import pathlib

    package = pathlib.Path(entry_points.__file__).parent / "glossaflow"
    for path in package.rglob("*.py"):
        if "llm" not in path.parts:
            assert "glossaflow.llm" not in path.read_text(), path
