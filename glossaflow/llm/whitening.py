"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries are scaled and rounded down to whole numbers ``x``, so that sums are exact. The fit list holds each distinct
vector once, as blocks of whole numbers in a written table. With the centred rows ``X`` of that list, ``X V = U B`` is
built column by column: a step is one pass over the blocks, in which every task forms ``X q`` and returns its products
with all earlier left vectors, its square, and ``Xᵀ (X q)``; sums over the tasks are made by Spark. Left vectors are as
long as the fit list and are stored nowhere: each is ``X p`` with a short ``p``, and tasks form them again where they
need them. Both sides are orthogonalised in full against all earlier vectors; the left side a second time, by a second
pass, if the first time took away half of it or more. A step that meets an invariant subspace goes on from a new random
direction, so that repeated eigenvalues are found as often as they occur. The singular values and right vectors of the
small bidiagonal matrix ``B`` give components and deviations.

The driver holds matrices of ``dims`` times ``steps``, nothing that grows with the rows. Rows are centred as
``(n x - S) / n`` with exact ``n x - S``, never by subtracting large sums of products. By default there are as many steps as
dimensions, which leaves no component out; ``steps`` shortens this for very long vectors.

Losing an executor repeats tasks of one pass. A vector that makes up a third of all rows is combined in each task before
the list is shuffled; the rows themselves are not shuffled at all.

Results: rows whose vector is null or holds null, NaN or infinite entries are left out, an empty vector too if all are
empty. Shorter vectors count as if they ended in zeros. Entries that exceed 2^48 after scaling count as 2^48. Repeated
rows and ids are all kept. Directions without variance are no components, so one distinct vector or none gives none.
A deviation beyond 2^63 is null. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from glossaflow.llm.common import quoted
from glossaflow.scratch import stage

COMPONENTS = 16
LARGEST = float(1 << 48)
# What is below this share of the largest singular value counts as zero: couplings in a step, then deviations.
NO_COUPLING = 1e-12
NO_DEVIATION = 1e-10


@dataclass(frozen=True)
class Whitening:
    """A fit: sums of the ``n`` whole-number vectors, unit components as columns, and their standard deviations."""

    n: int
    sums: list[int]
    largest: int
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_numbers(vector: Column, scale: float, offset: int) -> Column:
    """Entries as ``floor(scale * entry) + offset``; null for a vector that cannot be used."""
    def finite(entry: Column) -> Column:
        return entry.isNotNull() & ~F.isnan(entry.cast("double")) & (F.abs(entry.cast("double")) < float("inf"))

    def whole(entry: Column) -> Column:
        scaled = entry.cast("double") * F.lit(float(scale))
        return F.floor(F.greatest(F.least(scaled, F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(offset).cast("long")

    return F.when(F.forall(vector, finite), F.transform(vector, whole))


def whole_vectors(vectors: DataFrame, column: str, scale: float, offset: int, keep: list[str]) -> tuple[DataFrame, int]:
    """The usable rows as ``(*keep, x)`` with all ``x`` of one length, and that length."""
    usable = vectors.select(*[quoted(k) for k in keep], whole_numbers(quoted(column), scale, offset).alias("x")).where("x is not null")
    dims = usable.agg(F.max(F.size("x"))).first()[0] or 0
    lacking = F.array_repeat(F.lit(offset).cast("long"), F.lit(dims) - F.size("x"))
    return usable.withColumn("x", F.when(F.size("x") < dims, F.concat("x", lacking)).otherwise(F.col("x"))), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _packed(rows: DataFrame, dims: int) -> DataFrame:
    """Rows as blocks of little-endian longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = _matrix(batch.column("x"), dims).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    return rows.select("x").mapInArrow(run, "data binary")


def _summed(blocks: DataFrame, dims: int, of_block: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """The sum over all blocks of the vector ``of_block`` makes of one; added up in the tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("data"):
                part = of_block(np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims))
                if kind == "double" and total is not None:
                    total += part
                    continue
                if total is not None:
                    yield made(total)
                total = part
        if total is not None:
            yield made(total)

    def made(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])

    value = F.col("value") if kind == "double" else F.col("value").cast("decimal(38,0)")
    parts = blocks.mapInArrow(run, f"place int, value {kind}")
    return [r["total"] for r in sorted(parts.groupBy("place").agg(F.sum(value).alias("total")).collect())]


def _spread(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """``n * x - S``, exact: as longs if they suffice, else as Python numbers."""
    if 2 * n * largest < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def bidiagonalise(
    product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]], dims: int, steps: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(V, B)`` with ``X V = U B``, B upper bidiagonal, V and U orthonormal.

    ``product(q, P)`` returns ``(X P)ᵀ X q``, the square of ``X q``, and ``Xᵀ X q``.
    """
    dice = np.random.default_rng(seed)
    right, left, back = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    small = np.zeros((steps, steps))

    def fresh() -> np.ndarray:
        return _orthogonal(dice.standard_normal(dims), right)

    v, beta, scale = fresh(), 0.0, 0.0
    for j in range(steps):
        v = v / np.linalg.norm(v)
        right = np.column_stack([right, v])
        q = v - beta * left[:, -1] if beta else v
        along, square, image = product(q, left)
        if square - along @ along < square / 2:
            q = q - left @ along
            along, square, image = product(q, left)
        alpha = float(np.sqrt(max(square - along @ along, 0.0)))
        scale = max(scale, alpha, beta)
        if alpha <= NO_COUPLING * scale:
            alpha, p, g = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            p, g = (q - left @ along) / alpha, (image - back @ along) / alpha
        left, back = np.column_stack([left, p]), np.column_stack([back, g])
        small[j, j] = alpha
        if j + 1 == steps:
            break
        v = _orthogonal(g - alpha * v, right)
        beta = float(np.linalg.norm(v))
        if beta <= NO_COUPLING * scale:
            v, beta = fresh(), 0.0
        small[j, j + 1] = beta
    return right, small


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS, steps: int | None = None, seed: int = 0) -> Whitening:
    """The whitening of the distinct ``x`` (arrays of ``dims`` longs) in ``rows``."""
    if not dims:
        return Whitening(0, [], 0, np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    blocks = stage(_packed(rows.select("x").distinct(), dims), "blocks")
    n, *sums = (int(t) for t in _summed(blocks, dims, lambda x: np.append(len(x), x.sum(axis=0)), "bigint"))
    extreme = rows.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0]

    def centred(x: np.ndarray) -> np.ndarray:
        return _spread(x, n, sums, extreme).astype(float) / n

    def product(q: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        def of_block(x: np.ndarray) -> np.ndarray:
            rows = centred(x)
            u = rows @ q
            return np.concatenate([(rows @ left).T @ u, [u @ u], u @ rows])

        total = np.array(_summed(blocks, dims, of_block))
        k = left.shape[1]
        return total[:k], float(total[k]), total[k + 1:]

    right, small = bidiagonalise(product, dims, min(dims, steps or dims), seed)
    _, singular, turned = np.linalg.svd(small)
    there = singular > NO_DEVIATION * singular[0]
    k = min(components, int(there.sum()))
    found, deviations = right @ turned[:k].T, singular[:k] / np.sqrt(n)
    found /= np.linalg.norm(found, axis=0)
    if not k:
        return Whitening(n, sums, extreme, found, deviations, deviations, 0.0)

    scaled = found / deviations
    first = np.array(_summed(blocks, dims, lambda x: np.append((centred(x) @ scaled).sum(axis=0), (centred(x) ** 2).sum()))) / n
    mean, trace = first[:k], first[k]

    def outer(x: np.ndarray) -> np.ndarray:
        white = centred(x) @ scaled - mean
        return (white.T @ white).ravel()

    covariance = np.array(_summed(blocks, dims, outer)).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, sums, extreme, found, deviations, deviations**2 / trace, error)


def transform(rows: DataFrame, dims: int, model: Whitening) -> DataFrame:
    """``rows`` with ``deviation`` and the array ``whitened`` in place of ``x``."""
    kept = [f for f in rows.schema.fields if f.name != "x"]
    schema = StructType([*kept, StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
    n, sums, extreme, scaled = model.n, model.sums, model.largest, model.components / model.deviations
    names, k = [f.name for f in kept], scaled.shape[1]
    wide = (2 * n * extreme) ** 2 * dims >= 1 << 62

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spread = _spread(_matrix(batch.column("x"), dims), n, sums, extreme)
            if wide:
                square = [s if s < 1 << 63 else None for s in (spread.astype(object) ** 2).sum(axis=1).tolist()]
            else:
                square = (spread**2).sum(axis=1)
            white = (spread.astype(float) / n) @ scaled
            offsets = pa.array(np.arange(0, (len(white) + 1) * k, k, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(square, pa.int64()), lists], [*names, "deviation", "whitened"])

    return rows.mapInArrow(run, schema)


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: float = 64, offset: int = 1_000_000,
    components: int = COMPONENTS, steps: int | None = None,
) -> tuple[DataFrame, Whitening]:
    """The usable rows as ``(id, deviation, whitened)`` and the fit they were whitened by."""
    rows, dims = whole_vectors(vectors, column, scale, offset, [id_column])
    model = fit(rows, dims, components, steps)
    if not len(model.deviations):
        rows = rows.limit(0)
    return transform(rows, dims, model), model
