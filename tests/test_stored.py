"""Stored blocks against brute force; none of them may be shuffled."""

import math

import numpy as np
import pytest

from starloom import session
from starloom.operators import blocks, content, serving, stored

CASES = [(2048, 16, 1 << 24), (16, 2, 200)]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    some = rng.normal(size=(45, 24)) * (rng.random((45, 24)) < 0.3)
    some[:, :3] = rng.normal(size=(45, 3)) * 2  # features that all share
    some[7] = some[11]  # ties
    some[9] = some[11]
    return some


@pytest.fixture(scope="module")
def vectors(spark, table):
    rows = [(int(i) + 1, int(f) - 3, float(table[i, f])) for i, f in zip(*np.nonzero(table))]
    return spark.createDataFrame(rows, "id bigint, feature bigint, val double").cache()


def small(monkeypatch, case):
    for name, value in zip(("BLOCK_IDS", "HEAVY", "DENSE"), case):
        monkeypatch.setattr(stored, name, value)


def best(scores, k):
    return {i + 1: [int(j) + 1 for j in sorted(np.flatnonzero(row > -np.inf), key=lambda j: (-round(row[j], 9), j))[:k]] for i, row in enumerate(scores)}


def lists(rows, key="id", other="other"):
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r[key], []).append(r[other])
    return got


@pytest.mark.parametrize("case", CASES)
def test_neighbours_match_brute_force(vectors, table, monkeypatch, case):
    small(monkeypatch, case)
    unit = table / np.linalg.norm(table, axis=1, keepdims=True)
    sims = unit @ unit.T
    np.fill_diagonal(sims, -np.inf)
    found = content.content_neighbours(vectors, 5).collect()
    assert lists(found) == best(sims, 5)
    assert all(math.isclose(r["score"], sims[r["id"] - 1, r["other"] - 1], rel_tol=1e-9, abs_tol=1e-12) for r in found)
    pairs = {(r["id"], r["other"]) for r in content.similar_content(vectors, 0.6).collect()}
    assert pairs == {(a + 1, b + 1) for a, b in zip(*np.nonzero(sims > 0.6))} and pairs


@pytest.mark.parametrize("case", CASES)
def test_blend_profiles_and_lists_are_as_by_block_products(spark, vectors, table, monkeypatch, case):
    small(monkeypatch, case)
    rng = np.random.default_rng(8)
    rows = [(u, int(i) + 1, float(rng.integers(1, 6))) for u in range(1, 20) for i in rng.choice(45, 6, replace=False)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    wide = dict(block_ids=4096)
    assert lists(content.blended_neighbours(vectors, 4).collect()) == lists(content.blended_neighbours(vectors, 4, **wide).collect())
    by_profile = [lists(content.recommend_by_profile(ratings, vectors, 6, **o).collect(), "user_id", "item_id") for o in ({}, wide)]
    assert by_profile[0] == by_profile[1] and len(by_profile[0]) == 19
    unit = table / np.linalg.norm(table, axis=1, keepdims=True)
    weights = np.zeros((19, 45))
    for u, i, r in rows:
        weights[u - 1, i - 1] = (r - 3) / 2 / 6
    scores = weights @ unit @ (unit.T @ unit) @ unit.T
    for u, i, _ in rows:
        scores[u - 1, i - 1] = -np.inf
    scores[scores <= 0] = -np.inf
    got = lists(serving.content_lists(ratings, vectors, 8).collect(), "user_id", "item_id")
    assert got == {u: some for u, some in best(scores, 8).items() if some}


def test_missing_values_hide_the_pairs_that_share_them(spark, vectors):
    odd = spark.createDataFrame([(1, 20, None), (2, 20, 1.0), (3, -3, None)], "id bigint, feature bigint, val double")
    rows = vectors.where("NOT (id IN (1, 2) AND feature = 20) AND NOT (id = 3 AND feature = -3)").unionByName(odd)
    pairs = {(r["id"], r["other"]) for r in content.content_neighbours(rows, 50).collect()}
    assert (1, 2) not in pairs and (2, 1) not in pairs and not [p for p in pairs if 3 in p]
    assert (2, 4) in pairs


def test_blocks_are_read_again_and_not_shuffled(vectors):
    plan = content.similar_content(vectors, 0.6)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    plan = content.content_neighbours(vectors, 5)._jdf.queryExecution().executedPlan().toString()
    # only the lists are
    assert "CartesianProduct" in plan and plan.count("Exchange") == 1


def test_users_times_features_are_not_stored(spark, vectors, monkeypatch):
    labels = []
    keep = session.materialize
    for module in (serving, stored, content, blocks):
        if hasattr(module, "materialize"):
            monkeypatch.setattr(module, "materialize", lambda df, label: labels.append(label) or keep(df, label))
    ratings = spark.createDataFrame([(1, 2, 5.0), (1, 3, 1.0)], "user_id bigint, item_id bigint, rating double")
    serving.content_lists(ratings, vectors, 3).collect()
    assert labels and "reach" not in labels


def test_missing_and_repeated_cells_of_lists(spark):
    cells = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 2.0), (2, 3, 1.0), (2, 3, 1.0), (3, 1, 1.0), (4, 1, 1.0), (4, 2, None), (5, 2, 1.0), (6, 2, 1.0), (6, 4, 1.0)]
    vectors = spark.createDataFrame(cells, "id bigint, feature bigint, val double")
    ratings = spark.createDataFrame([(7, 1, 5.0), (8, 1, 5.0), (8, 2, None)], "user_id bigint, item_id bigint, rating double")
    got = lists(serving.content_lists(ratings, vectors, 9).collect(), "user_id", "item_id")
    # products with a missing value are left out: item 4 is not listed, item 5 reaches nothing; a user with a missing sum has no list
    assert set(got) == {7} and set(got[7]) == {2, 3, 6}
