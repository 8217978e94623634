"""Block products against brute force, with and without hot ids."""

import math

import numpy as np
import pytest

from starloom.operators import blocks, collaborative as cf

CASES = [dict(block_ids=4096, hot_rows=10**9), dict(block_ids=7, hot_rows=10**9), dict(block_ids=7, hot_rows=12)]


@pytest.fixture(scope="module")
def dense():
    rng = np.random.default_rng(7)
    table = rng.integers(1, 6, (40, 30)) * (rng.random((40, 30)) < 0.25)
    table[:, 3] = rng.integers(1, 6, 40)  # an item everybody rated
    table[5, :] = rng.integers(1, 6, 30)  # a user who rated everything
    return table.astype(float)


@pytest.fixture(scope="module")
def ratings(spark, dense):
    rows = [(u + 1, i + 1, dense[u, i]) for u, i in zip(*np.nonzero(dense))]
    rows = [(int(u), int(i), float(r)) for u, i, r in rows]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double").cache()


def cosines(dense):
    unit = dense / np.linalg.norm(dense, axis=0)
    sims = unit.T @ unit
    np.fill_diagonal(sims, -np.inf)
    return sims


@pytest.mark.parametrize("options", CASES)
def test_neighbours_match_brute_force(ratings, dense, options):
    sims = cosines(dense)
    got = {}
    for r in cf.neighbours(ratings, "item_id", 5, **options).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], r["score"]))
    for item in range(dense.shape[1]):
        row = sims[item]
        order = sorted((j for j in range(len(row)) if row[j] > 0), key=lambda j: (-round(row[j], 9), j))[:5]
        have = sorted(got.get(item + 1, []))
        assert [o for _, o, _ in have] == [j + 1 for j in order]
        assert [r for r, _, _ in have] == list(range(1, len(order) + 1))
        assert np.allclose([s for _, _, s in have], row[order])


@pytest.mark.parametrize("options", CASES)
def test_similar_is_symmetric_and_complete(ratings, dense, options):
    sims = cosines(dense.T)
    got = {(r["id"], r["other"]): r["score"] for r in cf.similar(ratings, "user_id", 0.3, **options).collect()}
    want = {(a + 1, b + 1): sims[a, b] for a, b in zip(*np.nonzero(sims > 0.3))}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[p], want[p], rel_tol=1e-9) for p in want)
    assert all((b, a) in got for a, b in got)


@pytest.mark.parametrize("options", CASES)
def test_weighted_scores_leave_the_target_out(ratings, dense, options):
    sims = cosines(dense)
    np.fill_diagonal(sims, 0.0)
    rows = blocks.weighted_scores(cf.vectors(ratings, "item_id"), ratings, ratings, **options).collect()
    want = {}
    for u, i in zip(*np.nonzero(dense)):
        weight = sims[i] * (dense[u] > 0)
        if weight.sum() > 0:
            want[(u + 1, i + 1)] = (weight @ dense[u], weight.sum())
    got = {(r["user_id"], r["item_id"]): (r["num"], r["den"]) for r in rows}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[p], want[p]) for p in want)


@pytest.mark.parametrize("options", CASES)
def test_supporters_are_the_closest_rated_items(ratings, dense, options):
    sims = cosines(dense)
    rows = blocks.supporters(cf.vectors(ratings, "item_id"), ratings, ratings, 2, 0.2, **options).collect()
    got = {}
    for r in rows:
        got.setdefault((r["user_id"], r["item_id"]), []).append((r["rank"], r["other"]))
    for u, i in zip(*np.nonzero(dense)):
        near = [j for j in np.flatnonzero(dense[u]) if sims[i, j] > 0.2]
        near = sorted(near, key=lambda j: (-round(sims[i, j], 9), j))[:2]
        assert [o for _, o in sorted(got.get((u + 1, i + 1), []))] == [j + 1 for j in near]


@pytest.mark.parametrize("options", CASES)
def test_two_sides_with_exclusions(spark, ratings, dense, options):
    left = ratings.selectExpr("user_id AS id", "item_id AS dim", "rating AS val")
    right = spark.createDataFrame(
        [(100 + j, int(i) + 1, float(1 + (i * j) % 3)) for j in range(9) for i in range(30)], "id bigint, dim bigint, val double"
    )
    skip = spark.createDataFrame([(u, 100 + u % 9) for u in range(1, 41)], "id bigint, other bigint")
    matrix = np.array([[1 + (i * j) % 3 for i in range(30)] for j in range(9)], float)
    scores = dense @ matrix.T
    for u in range(1, 41):
        scores[u - 1, u % 9] = -np.inf
    got = {}
    for r in blocks.nearest(left, right, k=3, exclude=skip, **options).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"], r["score"]))
    for u in range(40):
        order = sorted((j for j in range(9) if scores[u, j] > 0), key=lambda j: (-scores[u, j], j))[:3]
        assert [o for _, o, _ in sorted(got[u + 1])] == [100 + j for j in order]


@pytest.mark.parametrize("options", CASES)
@pytest.mark.parametrize("k", [None, 2])
def test_zero_and_negative_scores_are_kept(spark, k, options):
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, -1.0), (2, 2, 1.0), (3, 1, -1.0), (4, 3, 2.0)]
    options = dict(options, hot_rows=1) if options["hot_rows"] == 12 else options
    vectors = spark.createDataFrame(rows, "id bigint, dim bigint, val double")
    skip = spark.createDataFrame([(1, 2)], "id bigint, other bigint")
    table = np.zeros((5, 4))
    for i, d, v in rows:
        table[i, d] = v
    for exclude, left_out in ((None, set()), (skip, {(1, 2)})):
        found = blocks.nearest(vectors, k=k, min_score=-math.inf, exclude=exclude, **options)
        want = {}
        for a in range(1, 5):
            scored = [(-float(table[a] @ table[b]), b) for b in range(1, 5) if a != b and (a, b) not in left_out]
            want |= {(a, b): -s for s, b in sorted(scored)[:k]}
        assert {(r["id"], r["other"]): r["score"] for r in found.collect()} == want


@pytest.mark.parametrize("options", CASES)
def test_only_positive_similarities_count(spark, options):
    rng = np.random.default_rng(3)
    table = rng.normal(size=(12, 6))
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    cells = [(i, d, float(table[i, d])) for i in range(12) for d in range(6)]
    units = spark.createDataFrame(cells, "id bigint, dim bigint, val double")
    history = [(u, i, float(1 + (u * i) % 5)) for u in range(4) for i in range(12) if (u + i) % 3]
    ratings = spark.createDataFrame(history, "user_id bigint, item_id bigint, rating double")
    got = {(r["user_id"], r["item_id"]): r["predicted"] for r in cf.predict_by_positive(ratings, units, ratings, **options).collect()}
    for user, item, _ in history:
        near = [(max(0.0, table[item] @ table[j]), r) for u, j, r in history if u == user and j != item]
        total = sum(s for s, _ in near)
        want = min(5, max(1, sum(s * r for s, r in near) / total)) if total else 3.0
        assert math.isclose(got[user, item], want, rel_tol=1e-9)


def test_dense_and_sparse_products_agree(monkeypatch, ratings):
    plain = sorted(map(tuple, cf.similar(ratings, "item_id", 0.0).collect()))
    product = blocks._Product
    rng = np.random.default_rng(1)
    n = rng.integers(1, 4, 50)
    off = np.concatenate(([0], np.cumsum(n)))
    ids = np.concatenate([rng.choice(9, c, replace=False) for c in n])
    vals = rng.random(len(ids))
    out = []
    for ratio in (0, 10**9):
        monkeypatch.setattr(blocks, "DENSE_RATIO", ratio)
        block = product()
        block.add(off, ids, vals, off, ids, vals)
        left, right = block.ids()
        out.append({(a, b): s for a, row in zip(left, block.scores()) for b, s in zip(right, row)})
    assert out[0].keys() == out[1].keys() and all(math.isclose(out[0][p], out[1][p]) for p in out[0])
    assert plain


@pytest.mark.parametrize("options", CASES)
def test_best_means_match_brute_force(spark, ratings, dense, options):
    near = cf.similar(ratings, "item_id", min_score=0.3)
    rows = near.collect()
    left = ratings.selectExpr("user_id AS id", "item_id AS dim", "rating AS val")
    skip = ratings.selectExpr("user_id AS id", "item_id AS other")
    found = {}
    for r in blocks.best_means(left, near.selectExpr("id", "other AS dim", "score AS val"), 4, skip, **options).collect():
        found.setdefault(r["id"], []).append((r["rank"], r["other"], round(r["score"], 9), r["support"]))
    weights = np.zeros((30, 30))
    for r in rows:
        weights[r["id"] - 1, r["other"] - 1] = r["score"]
    for user in range(40):
        rated = dense[user] > 0
        scored = []
        for item in np.flatnonzero(~rated):
            w = np.where(rated, weights[item], 0)
            if w.any():
                scored.append((-round(float(w @ dense[user] / w.sum()), 9), int(item) + 1, int((w > 0).sum())))
        want = [(place, item, -score, n) for place, (score, item, n) in enumerate(sorted(scored)[:4], 1)]
        assert [(a, b, pytest.approx(c), d) for a, b, c, d in want] == sorted(found.get(user + 1, []))


def test_best_of_a_block_copies_a_strip_at_a_time():
    import tracemalloc

    scores = np.random.default_rng(1).random((4000, 4000))
    right = np.arange(4000)[::-1].copy()
    tracemalloc.start()
    rows, cols, values = blocks._best_cells(right, scores.T, 3, -np.inf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < scores.nbytes / 2
    assert (rows == np.repeat(np.arange(4000), 3)).all() and (values == scores.T[rows, cols]).all()
    assert (np.sort(values.reshape(-1, 3)) == np.sort(scores.T)[:, -3:]).all()
    assert [len(part) for part in blocks._best_cells(right[:0], np.zeros((0, 0)), 3, 0.0)] == [0, 0, 0]
