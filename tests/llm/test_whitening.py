"""Whitening against the eigenvectors of the whole covariance, in exact sums where the contract wants them."""

from __future__ import annotations

import math

import numpy as np
import pytest

from starloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, n string, component string, label int"


def plain(rows):
    """``vec_id`` and whole numbers of usable rows, mean, eigenvalues, components, trace, deviations."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in usable], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in usable], centred, values[::-1], vectors[:, ::-1], deviations


def checked(spark, rows, parts=3):
    frame = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA).repartition(parts)
    found = whitening.whiten(frame, whitening.train(frame)).collect()
    ids, centred, values, vectors, deviations = plain(rows)
    keep = min(8, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == keep * len(ids)
    expected = centred @ vectors[:, :keep] / np.sqrt(values[:keep])
    by_component = {c: sorted((r.vec_id, r.deviation, r.whitened) for r in found if r.component == c) for c in range(1, keep + 1)}
    for c in range(keep):
        mine = sorted(zip(ids, deviations, expected[:, c]))
        theirs = by_component[c + 1]
        assert [r[:2] for r in mine] == [r[:2] for r in theirs]
        sign = np.sign(mine[0][2] * theirs[0][2])
        assert np.allclose([r[2] for r in theirs], [sign * r[2] for r in mine], rtol=1e-7, atol=1e-7)
    assert {r.n for r in found} == {len(ids)} and max(r.identity_error for r in found) < 1e-9
    assert np.allclose([next(r.explained for r in found if r.component == c + 1) for c in range(keep)], values[:keep] / values.sum(), rtol=1e-10)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(4)
    mixed = rng.standard_normal((400, 12)) @ rng.standard_normal((12, 12))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    rows += [(900, None), (901, [1.0] * 11 + [None]), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11)]
    rows += [(5000 + i, rows[0][1]) for i in range(200)]  # one very common vector
    checked(spark, rows)


def test_few_dimensions_flat_directions_and_large_values(spark):
    rng = np.random.default_rng(5)
    checked(spark, [(i, [float(c) for c in v] + [3.0]) for i, v in enumerate(rng.standard_normal((50, 3)))])
    checked(spark, [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((6, 20)))], 1)
    checked(spark, [(i, [float(1e6 + c) for c in v]) for i, v in enumerate(rng.standard_normal((50, 3)) * 1000)])


def test_equal_eigenvalues_are_all_found(spark):
    axes = [(i, [float(s) if j == i // 2 else 0.0 for j in range(10)]) for i in range(20) for s in [1 if i % 2 else -1]]
    frame = spark.createDataFrame(axes, "vec_id bigint, embedding array<float>")
    model = whitening.train(frame)
    assert len(model.eigenvalues) == 8 and np.allclose(model.eigenvalues, model.eigenvalues[0]) and model.identity_error < 1e-9


def test_rows_that_cannot_be_whitened(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0, 3.0])] * 5):
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        assert whitening.whiten(frame, whitening.train(frame)).count() == 0
    ragged = [(i, [float(i), 1.0, float(i * i)]) for i in range(9)] + [(50, [1.0]), (51, [1.0] * 7)] * 3
    frame = spark.createDataFrame(ragged, "vec_id bigint, embedding array<float>")
    assert {r.vec_id for r in whitening.whiten(frame, whitening.train(frame)).collect()} == set(range(9))


def test_deviation_beyond_a_long_is_null():
    centre = whitening.Centre(3, np.array([3 * (1 << 40), 0], dtype=object))
    assert centre.deviation(np.array([[0, 1], [1 << 40, 2]])) == [None, 36]


@pytest.mark.parametrize("steps", [None, 12])
def test_bidiagonal_matrix(steps):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 30)) * np.geomspace(1, 1e-6, 30)
    right, small = whitening.bidiagonalised(lambda h: np.append(x.T @ (x @ h), (x @ h) @ (x @ h)), 30, steps or 30, np.linalg.norm(x))
    assert np.allclose(right.T @ right, np.eye(steps or 30), atol=1e-12)
    top = np.linalg.svd(small, compute_uv=False)
    assert np.allclose(top[:4], np.linalg.svd(x, compute_uv=False)[:4], rtol=1e-9)
