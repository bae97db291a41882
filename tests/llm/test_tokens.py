"""Byte BPE against the public library, packing by exact round trip, token counts against the library."""

import base64

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from glossaflow.llm import bpe, packing, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CODER = bpe.Coder(bpe.parse_ranks(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
    base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))})
TEXTS = ["", None, "Hello  world\n\n x", "It's ÜBER-straße 日本語 🙂 <|endoftext|>", "a" * 5000, "ab" * 3000, "x", "x"]


@given(st.text(st.characters(blacklist_categories=["Cs"]), max_size=200))
@settings(max_examples=200, deadline=None)
def test_encoding_equals_the_library(text):
    assert CODER.encode(text) == LIBRARY.encode_ordinary(text)
    assert CODER.decode(CODER.encode(text)) == text.encode()


def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_round_trip_over_a_table(spark):
    docs = documents(spark).selectExpr("*", "1 as token_ids", "'x' as decoded")
    for found in (bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN),
                  bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)):
        rows = {r["doc_id"]: r for r in found.collect()}
        assert len(rows) == len(TEXTS)
        for i, text in enumerate(TEXTS):
            assert rows[i]["token_ids"] == LIBRARY.encode_ordinary(text or "")
            assert bytes(rows[i]["decoded"]) == (text or "").encode()
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=200, deadline=None)
def test_best_fit_decreasing_equals_a_plain_search(lengths):
    rows = packing.best_fit_decreasing(lengths, 64)
    assert sorted(n for row in rows for n in row) == list(range(len(lengths)))
    free = []  # plain best fit: the fullest open row that still takes the piece
    for length in sorted(lengths, reverse=True):
        fits = [i for i, left in enumerate(free) if left >= length]
        best = min(fits, key=lambda i: free[i], default=None)
        if best is None:
            free.append(64 - length)
        else:
            free[best] -= length
    assert sorted(64 - sum(lengths[n] for n in row) for row in rows) == sorted(free)


def test_packed_rows_unpack_to_the_tokens(spark):
    docs = documents(spark).repartition(2)
    packed = packing.pack(docs, RANKS, public_tokenizers.PATTERN, row_length=256, shard_tokens=2000)
    for row in packed.collect():
        ids, places = np.frombuffer(row["input_ids"], "<u2"), np.frombuffer(row["position_ids"], "<u2")
        assert len(ids) == len(places) == 256 and row["cu_seqlens"][-1] == row["n_tokens"]
        for start, end in zip(row["cu_seqlens"], row["cu_seqlens"][1:]):
            assert places[start:end].tolist() == list(range(end - start))
        assert set(ids[row["n_tokens"] :].tolist()) <= {50256}
    pieces = {}
    for row in packing.unpack(packed, 256).collect():
        pieces.setdefault(row["doc_id"], {})[row["piece"]] = row["ids"]
    for i, text in enumerate(TEXTS):
        assert sum((pieces.get(i, {})[n] for n in sorted(pieces.get(i, {}))), []) == LIBRARY.encode_ordinary(text or "")
    assert packing.pack(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_equal_the_library_and_are_cached(spark, tmp_path, name):
    path, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    if name.endswith(".model"):
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        expected = [len(processor.encode(t or "")) for t in TEXTS]
    else:
        expected = [len(LIBRARY.encode(t or "", disallowed_special=(), allowed_special=set())) for t in TEXTS]
        expected[3] = None  # special strings follow the other library's default
    docs = documents(spark).selectExpr("*", "0 as n_tokens")
    for _ in range(2):
        rows = token_counts.count_tokens(docs, path, cache).collect()
        assert len(rows) == len(TEXTS)
        for row in rows:
            if expected[row["doc_id"]] is not None:
                assert row["n_tokens"] == expected[row["doc_id"]]
            assert row["n_bytes"] == len((TEXTS[row["doc_id"]] or "").encode())
    assert spark.read.parquet(cache).count() == len({t or "" for t in TEXTS})
    more = spark.createDataFrame([(1, "new text"), (2, "x")], "doc_id long, text string")
    assert token_counts.count_tokens(more, path, cache).count() == 2
    assert spark.read.parquet(cache).count() == len({t or "" for t in TEXTS}) + 1
    assert token_counts.count_tokens(docs.limit(0), path, str(tmp_path / "none")).collect() == []
