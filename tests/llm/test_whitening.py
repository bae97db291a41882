"""Whitening against the eigenvectors of the covariance, worked out from exact numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossaflow.llm import whitening
from glossaflow.llm.queries import op13_whitening


def brute_force(rows, top=16):
    """``{id: (deviation, |whitened|)}`` lists, n, explained; components by ``eigh``."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fitted = sorted({tuple(x) for _, x in kept})
    n = len(fitted)
    sums = [sum(column) for column in zip(*fitted)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fitted])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:top]
    order = [i for i in order if values[i] > 1e-18 * values.max()]
    made = []
    for i, x in kept:
        away = [n * a - s for a, s in zip(x, sums)]
        white = np.array([float(Fraction(a, n)) for a in away]) @ vectors[:, order] / np.sqrt(values[order])
        made.append((i, sum(a * a for a in away), white))
    return made, n, values[order] / values.sum()


def collected(white):
    return sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in white.collect())


def check(spark, rows, schema="vec_id long, embedding array<float>", tolerance=1e-9):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    rows = [(r[0], r[1]) for r in frame.collect()]
    white, model = whitening.whiten(frame)
    want, n, explained = brute_force(rows)
    got = collected(white)
    want.sort(key=lambda w: (w[0], w[1], tuple(w[2])))
    assert model.n == n
    assert [(i, d) for i, d, _ in got] == [(i, d) for i, d, _ in want]
    assert np.allclose(model.explained, explained, rtol=1e-9)
    assert model.identity_error < 1e-9
    ours = np.array([w for _, _, w in got])
    theirs = np.array([w for _, _, w in want])
    assert ours.shape == theirs.shape
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours * signs - theirs).max() < tolerance
    return model


def test_given_vectors(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    check(spark, [(r["vec_id"], r["embedding"]) for r in docs.collect()])
    out = op13_whitening(spark, sf_dir)
    assert out.count() == 16 * docs.count()
    assert out.groupBy("vec_id").agg(F.sum("component").alias("s")).where("s != 136").count() == 0
    assert out.select("identity_error").distinct().count() == 1


def test_repeats_and_unusable_rows(spark):
    dice = np.random.default_rng(2)
    rows = [(i, [float(c) for c in dice.standard_normal(5) * [1, 2, 3, 4, 5]]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(3, rows[3][1])]
    rows += [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf"), 1.0, 1.0, 1.0, 1.0])]
    model = check(spark, rows)
    assert model.components.shape == (5, 5)


def test_wide_range_of_deviations(spark):
    """Eigenvalues over ten orders of magnitude, rotated."""
    dice = np.random.default_rng(3)
    turn = np.linalg.qr(dice.standard_normal((8, 8)))[0]
    data = dice.standard_normal((300, 8)) * 10.0 ** np.linspace(4, -1, 8) @ turn
    check(spark, [(i, [float(c) for c in row]) for i, row in enumerate(data)], "vec_id long, embedding array<double>", 1e-5)


def test_equal_eigenvalues_are_all_found(spark):
    """Unit vectors and their opposites: every direction has the same variance."""
    rows = [(i * 2 + s, [(1.0 - 2 * s) * (i == j) for j in range(6)]) for i in range(6) for s in (0, 1)]
    white, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert model.components.shape == (6, 6)
    assert np.allclose(model.explained, 1 / 6)
    assert model.identity_error < 1e-9
    assert np.allclose([sum(w * w for w in r["whitened"]) for r in white.collect()], 6)


def test_deficient_rank(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i % 3)]) for i in range(9)]
    assert check(spark, rows).components.shape == (4, 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    white, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert white.collect() == [] and len(model.explained) == 0


def test_ragged_and_huge(spark):
    rows = [(None, [1.0, 2.0, 0.5]), (1, [1.0]), (2, [2.0, 5.0]), (3, [1e38, -1e38, 3.0]), (3, [3.0, 3.0, 3.0])]
    white, model = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>"))
    made = {r["vec_id"]: r["deviation"] for r in white.collect() if r["vec_id"] != 3}
    x = [[math.floor(64 * max(min(c, 2.0**42), -(2.0**42))) + 10**6 for c in [*v, 0.0, 0.0][:3]] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    big = sum((5 * a - s) ** 2 for a, s in zip(x[0], sums))
    assert made[None] == (big if big < 1 << 63 else None) and model.n == 5
