"""Exact duplicates against a dictionary of texts, and the Golomb code against the values it was given."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glossaflow.llm import exact_dedup
from glossaflow.llm.exact_dedup import exact_duplicates, golomb_decode, golomb_encode


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**60 - 1), min_size=1, max_size=200), st.booleans())
def test_code_returns_its_values(values, dense):
    values = np.array(sorted({v % 500 for v in values} if dense else values), np.int64)
    start = int(values[0]) // 2
    parameter, high, rest = golomb_encode(values, start)
    assert golomb_decode(len(values), start, parameter, high, rest).tolist() == values.tolist()


def test_code_is_short():
    """A gap costs about log2(mean gap) + 1.5 bits."""
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 20_000))
    _, high, rest = golomb_encode(values, 0)
    assert 8 * (len(high) + len(rest)) / len(values) < np.log2((1 << 40) / len(values)) + 1.7


def brute_force(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for text, docs in groups.items():
        known = [d for d in docs if d is not None]
        keep = max(known) if known else None
        spare = 1
        for doc in docs:
            kept = doc == keep and spare == 1
            spare -= kept
            out.append((doc, keep, len(docs), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def texts(n=3000):
    dice = random.Random(5)
    rows = [(i, f"text {dice.randrange(n // 2)}") for i in range(n)]
    rows += [(n + i, "the same") for i in range(n // 2)] + [(n * 9, "x" * 300_000), (n * 9 + 1, "x" * 299_999 + "y")]
    rows += [(None, "no id"), (None, "no id"), (None, "alone"), (7, "id twice"), (7, "id twice"), (8, None), (9, ""), (10, None)]
    rows += [(5, " a"), (5, "a"), (5, "A"), (5, "\x00a")]
    dice.shuffle(rows)
    return rows


def as_rows(found):
    return sorted([tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=repr)


@pytest.mark.parametrize("spare_bits, wave_bytes", [(10, 32 << 20), (-9, 32 << 20), (10, 4096)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, spare_bits, wave_bytes):
    """Also with fingerprints so narrow that most are shared by different texts, and with a wave per file."""
    monkeypatch.setattr(exact_dedup, "SPARE_BITS", spare_bits)
    monkeypatch.setattr(exact_dedup, "WAVE_BYTES", wave_bytes)
    rows = texts()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert as_rows(exact_duplicates(docs, scan=True)) == brute_force(rows)


def test_frame_that_is_no_scan(spark):
    rows = texts(300)
    docs = spark.createDataFrame([(t, d, 1, "a") for d, t in rows], "body string, id long, file int, sha256 string")
    assert as_rows(exact_duplicates(docs, "id", "body")) == brute_force(rows)


def test_no_copies_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert as_rows(exact_duplicates(docs)) == brute_force([(1, "a"), (2, "b")])
    assert exact_duplicates(docs.limit(0)).count() == 0
