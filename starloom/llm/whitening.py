"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The vectors become whole numbers, are packed into blocks, and are written once.
Each step of the bidiagonalisation is one pass of Spark over the blocks: a task
centres its rows, multiplies them with a vector (``Xv``), and multiplies the
outcome back (``X'u``); one row of ``dims + 1`` sums leaves it. A left vector
``u = Xg`` is as long as the table and is never written: it is held by its
coefficients ``g``, from which tasks make it again, and its products with the
other left vectors follow from ``X'u``. Right and left vectors are both
orthogonalised twice against all earlier ones. The driver holds squares of the
number of dimensions, never a row of the table.

The bidiagonalisation runs through all dimensions by default, so that repeated
eigenvalues are found as well; when it breaks down it goes on from a vector
outside of what it has seen. The SVD of the small bidiagonal matrix yields the
components and the deviations along them, and one more pass measures the
covariance of the whitened rows.

Rows whose vector is null, or holds a null, NaN or infinite entry, are dropped,
and so are rows whose length is not the commonest one (the greater of equals).
Directions without spread cannot be whitened and are no components; if no
direction has any, or the table is empty, the result is empty. Repeated rows
and null ids are rows like any other, columns other than the id and the vector
are ignored. Entries beyond 2**51 / 1024 are cut there. A ``deviation`` beyond
the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import Scratch, longs, rebatched, received, send

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Vectors of a block: 4 MB at 1024 dimensions.
BLOCK_ROWS = 512
#: Spread below this part of the largest along any direction is rounding.
NO_SPREAD = 1e-12
_LIMIT = 2.0 ** 51
LOW_BITS = 24


def whole_numbers(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The usable rows of a batch of vectors, and their entries as whole numbers."""
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    usable = np.diff(offsets) == dims
    if vectors.null_count:
        usable &= vectors.is_valid().to_numpy(zero_copy_only=False)
    flat = vectors.values.slice(offsets[0], offsets[-1] - offsets[0])
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    rows = np.flatnonzero(usable)
    cells = values[(offsets[rows] - offsets[0])[:, None] + np.arange(dims)]
    finite = np.isfinite(cells).all(axis=1)
    scaled = np.clip(np.floor(cells[finite] * SCALE), -_LIMIT, _LIMIT)
    return rows[finite], scaled.astype(np.int64) + SHIFT


def packed(rows: DataFrame, dims: int) -> DataFrame:
    """Blocks of up to ``BLOCK_ROWS`` vectors as ``cells`` (little-endian longs)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BLOCK_ROWS):
            _, cells = whole_numbers(batch["vector"], dims)
            if len(cells):
                yield pa.record_batch({"cells": pa.array([cells.astype("<i8").tobytes()], pa.binary())})

    return rows.select("vector").mapInArrow(pack, "cells binary")


def summed(blocks: DataFrame, dims: int, kind: str, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of what ``f`` returns for a block, one vector of fixed length.

    Each task adds up its own blocks, and one task adds the tasks' vectors in
    the order of the tasks.
    """

    def add(batches: Iterator[pa.RecordBatch], make, column: str) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch[column]:
                part = make(np.frombuffer(cell.as_buffer(), kind if column == "part" else "<i8"))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({"part": pa.array([total.astype(kind).tobytes()], pa.binary())})

    parts = blocks.mapInArrow(lambda b: add(b, lambda x: f(x.reshape(-1, dims)), "cells"), "part binary")
    parts = parts.withColumn("task", F.spark_partition_id()).repartition(1).sortWithinPartitions("task").select("part")
    rows = parts.mapInArrow(lambda b: add(b, lambda x: x, "part"), "part binary").collect()
    return np.frombuffer(bytes(rows[0].part), kind) if rows else np.zeros(0, kind)


@dataclass
class Centre:
    """``n`` vectors with the whole sums ``sums`` per dimension (Python integers)."""

    n: int
    sums: np.ndarray

    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean's whole part, and what is left of the sums."""
        whole = self.sums // self.n
        return whole.astype(np.int64), (self.sums - whole * self.n).astype(np.int64)

    def apart(self, cells: np.ndarray) -> np.ndarray:
        """Rows less the mean: whole parts first, so that nothing is lost to large values."""
        whole, rest = self.mean()
        return (cells - whole).astype(float) - rest / self.n

    def deviation(self, cells: np.ndarray) -> list[int | None]:
        """The sum of ``(n * x - sum)**2`` of each row, exact."""
        whole, rest = self.mean()
        near = cells - whole
        largest = int(np.abs(near).max(initial=0)) * self.n + self.n
        if largest * largest * cells.shape[1] < 1 << 63:
            d = near * self.n - rest
            return (d * d).sum(axis=1).tolist()
        exact = ((near.astype(object) * self.n - rest.astype(object)) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact]


@dataclass
class Whitening:
    """Components (columns of unit vectors), eigenvalues of the covariance, its trace, and the whitened rows' error."""

    dims: int
    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def _apart(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2 if basis else 0):
        vector = vector - np.array(basis).T @ (np.array(basis) @ vector)
    return vector


def bidiagonalised(product: Callable[[np.ndarray], np.ndarray], dims: int, steps: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (columns) and the upper bidiagonal matrix, from ``product(h) = [X'p, p'p]`` with ``p = Xh``.

    ``product`` is the only pass over the table: ``p`` is the new left vector
    before it gets unit length, ``X'p`` the next right one before it is made
    orthogonal. ``size`` is the norm of ``X``.
    """
    random = np.random.default_rng(12)
    right, left, back = [], [], []  # v; g with u = Xg; X'u
    diagonal, above = [], []
    v = random.standard_normal(dims)
    v /= np.linalg.norm(v)
    beta = 0.0
    for _ in range(steps):
        right.append(v)
        h = v - beta * left[-1] if left and beta else v
        *w, square = product(h)
        w = np.array(w)
        for _ in range(2 if left else 0):  # p less its parts along earlier left vectors
            along = np.array(left) @ w
            h, w, square = h - np.array(left).T @ along, w - np.array(back).T @ along, square - along @ along
        alpha = float(np.sqrt(max(square, 0.0)))
        if alpha <= NO_SPREAD * size:
            alpha, g, z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            g, z = h / alpha, w / alpha
        left.append(g)
        back.append(z)
        diagonal.append(alpha)
        r = _apart(z - alpha * v, right)
        beta = float(np.linalg.norm(r))
        if beta <= NO_SPREAD * size:  # nothing new: go on from a vector that no step has seen
            beta, r = 0.0, _apart(random.standard_normal(dims), right)
            length = np.linalg.norm(r)
            if len(right) == dims or length < 1e-8:
                break
            v = r / length
        else:
            v = r / beta
        above.append(beta)
    n = len(right)
    return np.array(right).T, np.diag(diagonal) + np.diag(above[:n - 1], 1)


def train(vectors: DataFrame, count: int = COMPONENTS, steps: int | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> Whitening | None:
    """Learns the whitening of all usable vectors; None if there are none, or all are alike.

    ``steps`` passes over the table (all dimensions by default); fewer find the
    leading components of wide vectors, but may miss equal eigenvalues.
    """
    rows = vectors.select(F.col(vector_column).alias("vector"))
    sizes = rows.where("vector IS NOT NULL AND size(vector) > 0").groupBy(F.size("vector").alias("dims")).count()
    commonest = sizes.orderBy(F.desc("count"), F.desc("dims")).first()
    if commonest is None:
        return None
    dims, scratch, spark = commonest.dims, Scratch(vectors.sparkSession, "whitening"), vectors.sparkSession
    blocks = scratch.store(packed(rows, dims), "blocks")
    # high and low bits apart, so that no sum leaves the range of a long
    totals = summed(blocks, dims, "<i8", lambda x: np.concatenate([(x >> LOW_BITS).sum(axis=0), (x & (1 << LOW_BITS) - 1).sum(axis=0), [len(x)]]))
    if not len(totals):
        return None
    centre = Centre(int(totals[-1]), totals[:dims].astype(object) * (1 << LOW_BITS) + totals[dims:-1])
    squares = summed(blocks, dims, "<f8", lambda x: (centre.apart(x) ** 2).sum(axis=0))
    norm = float(np.sqrt(squares.sum()))
    if not norm:
        return None

    def product(h: np.ndarray) -> np.ndarray:
        held = send(spark, h)

        def both(cells: np.ndarray) -> np.ndarray:
            x = centre.apart(cells)
            p = x @ received(held)
            return np.append(x.T @ p, p @ p)

        try:
            return summed(blocks, dims, "<f8", both)
        finally:
            held.unpersist()

    right, small = bidiagonalised(product, dims, min(steps or dims, dims), norm)
    _, sigma, turned = np.linalg.svd(small)
    keep = int((sigma[:count] > 1e-7 * sigma[0]).sum())
    components = right @ turned[:keep].T
    components /= np.linalg.norm(components, axis=0)
    eigenvalues = sigma[:keep] ** 2 / centre.n
    white = components / np.sqrt(eigenvalues)

    def spread(cells: np.ndarray) -> np.ndarray:
        y = centre.apart(cells) @ white
        return np.append((y.T @ y).ravel(), y.sum(axis=0))

    found = summed(blocks, dims, "<f8", spread)
    mean = found[keep * keep:] / centre.n
    covariance = found[:keep * keep].reshape(keep, keep) / centre.n - np.outer(mean, mean)
    scratch.drop(blocks)
    return Whitening(dims, centre, components, eigenvalues, float(squares.sum()) / centre.n, float(np.abs(covariance - np.eye(keep)).max()))


FOUND = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Whitening | None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per usable vector and component: its whitened coordinate and the figures of the model."""
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {FOUND}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    held = send(vectors.sparkSession, model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = received(held)
        k = len(m.eigenvalues)
        white, explained = m.components / np.sqrt(m.eigenvalues), m.eigenvalues / m.trace
        for batch in rebatched(batches, BLOCK_ROWS):
            at, cells = whole_numbers(batch["vector"], m.dims)
            y = m.centre.apart(cells) @ white
            yield pa.record_batch({
                "vec_id": batch["vec_id"].take(longs(np.repeat(at, k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                "n": longs(np.full(len(at) * k, m.centre.n)),
                "deviation": pa.array(m.centre.deviation(cells), pa.int64()).take(longs(np.repeat(np.arange(len(at)), k))),
                "whitened": pa.array(y.ravel()),
                "explained": pa.array(np.tile(explained, len(at))),
                "identity_error": pa.array(np.full(len(at) * k, m.identity_error))})

    return rows.mapInArrow(apply, schema)
