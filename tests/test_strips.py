"""Strips against block products and plain sums."""

import random

import numpy as np
import pytest

from starloom.operators import blocks, collaborative as cf, serving, strips

SCHEMA = "user_id bigint, item_id bigint, rating double"


def _ratings(spark, users=60, items=40, seed=3):
    rnd = random.Random(seed)
    rows = [(u - 7, i * 10**12 - 5, float(rnd.randint(1, 5))) for u in range(users) for i in range(items) if rnd.random() < 0.2 or i == 0]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("chunk, buffer", [(1024, 4_000_000), (3, 50)])
def test_nearest_is_that_of_the_blocks(spark, monkeypatch, chunk, buffer):
    monkeypatch.setattr(strips, "CHUNK", chunk)
    monkeypatch.setattr(strips, "PRODUCTS", buffer)
    units = cf.vectors(_ratings(spark), "item_id")
    for options in (dict(k=3), dict(min_score=0.3), dict(k=5, min_score=0.2)):
        got = sorted((r["id"], r["other"], round(r["score"], 9), *r[3:]) for r in strips.nearest(units, **options).collect())
        want = sorted((r["id"], r["other"], round(r["score"], 9), *r[3:]) for r in blocks.nearest(units, **options).collect())
        assert got == want and got


def test_sparse_neighbours_need_no_second_shuffle(spark):
    plan = cf.neighbours(_ratings(spark), "item_id", 3)._jdf.queryExecution().executedPlan().toString()
    # the best of an id are cut where its products are summed
    assert "Window" not in plan


def test_means_keep_missing_values_and_nameless_rows(spark):
    near = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.25), (2, 1, 0.5), (4, 3, 0.5)], "id bigint, other bigint, score double")
    ratings = spark.createDataFrame([(9, 2, 4.0), (9, 3, None), (None, 2, 2.0), (8, 3, None)], SCHEMA)
    got = {(r["user_id"], r["item_id"]): r["predicted"] for r in cf.item_candidates(near, ratings).collect()}
    # (4.0 * 0.5) / (0.5 + 0.25), and nothing but missing values for the rest of item 3
    assert got == {(9, 1): pytest.approx(8 / 3), (9, 4): None, (8, 1): None, (8, 4): None, (None, 1): 2.0}
    best = {(r["user_id"], r["item_id"]) for r in cf.item_candidates(near, ratings, n=1).collect()}
    assert best == {(9, 1), (8, 1), (None, 1)}


@pytest.mark.parametrize("chunk, buffer", [(1024, 4_000_000), (3, 50)])
def test_pairs_above_are_those_of_unit_vectors(spark, monkeypatch, chunk, buffer):
    monkeypatch.setattr(strips, "CHUNK", chunk)
    monkeypatch.setattr(strips, "PRODUCTS", buffer)
    odd = [(1, -5, None), (None, -5, 3.0), (2, None, 3.0), (None, None, 1.0), (3, 77, 0.0), (4, 78, float("nan")), (5, 79, float("inf")),
           (4, -5, 2.5), (4, -5, 2.5), (6, -2**62, 4.0), (6, 2**62, 1e-3), (7, -2**62, 1e3), (7, 2**62, -2.0)]
    ratings = _ratings(spark).unionByName(spark.createDataFrame(odd, SCHEMA))
    for of in ("item_id", "user_id"):
        got = {(r["id"], r["other"]): r["score"] for r in cf.similar(ratings, of, 0.3).collect()}
        want = {(r["id"], r["other"]): r["score"] for r in strips.nearest(cf.vectors(ratings, of), min_score=0.3).collect()}
        assert got == pytest.approx(want) and got


def test_a_strip_gets_its_pairs_packed_and_once():
    rnd = np.random.default_rng(5)
    users, rated, count = 2000, 40, 200
    off = np.arange(users + 1) * rated
    ids = np.concatenate([rnd.choice(1_000_000, rated, replace=False) for _ in range(users)])
    cells = [(off, ids), (off, rnd.integers(1, 6, len(ids)).astype(float)), (off, rnd.integers(60, 76, len(ids)).astype(np.int16))]
    size, products = 0, 0
    for batch in strips._dealt(np.arange(users), cells * 2, strips.PAIRS, count):
        size += sum(len(part) for row in batch.column(2).to_pylist() for part in row)
        products += sum(sizes[2] for sizes in batch.column(1).to_pylist())
    # half of the pairs, 16 bytes each and more before
    assert products < 0.5 * users * rated * rated and size < 6 * products


@pytest.mark.parametrize("chunk, buffer", [(1024, 4_000_000), (3, 50)])
def test_rated_items_are_left_out_without_a_row_of_their_own(spark, monkeypatch, chunk, buffer):
    monkeypatch.setattr(strips, "CHUNK", chunk)
    monkeypatch.setattr(strips, "PRODUCTS", buffer)
    ratings = _ratings(spark)
    lists = serving.collaborative_lists(ratings, 5)
    assert "Union" not in lists._jdf.queryExecution().optimizedPlan().toString()
    rated = {(r["user_id"], r["item_id"]) for r in ratings.collect()}
    near = {(r["id"], r["other"]): r["score"] for r in cf.similar(ratings, "item_id", 0.1).collect()}
    want = {}
    for user, item, rating in ((r["user_id"], r["item_id"], r["rating"]) for r in ratings.collect()):
        for (one, other), score in near.items():
            if other == item and (user, one) not in rated:
                want.setdefault(user, {}).setdefault(one, []).append((score, rating))
    got = {(r["user_id"], r["item_id"]): (r["predicted"], r["confidence"]) for r in lists.collect()}
    best = {}
    for user, found in want.items():
        scored = sorted((-round(sum(s * r for s, r in v) / sum(s for s, _ in v), 9), one, min(0.9, len(v) / 10)) for one, v in found.items())
        best.update({(user, one): (pytest.approx(-score), support) for score, one, support in scored[:5]})
    assert got == best and got


@pytest.mark.parametrize("shift", [7, 0])
def test_rows_are_read_by_the_strips_and_not_shuffled_to_them(spark, monkeypatch, shift):
    # ids that are their own places, and others; many strips, a few to a task, and stored rows of a few cells
    monkeypatch.setattr(strips, "STORED", 40)
    monkeypatch.setattr(strips, "_count", lambda df, total: 40)
    rnd = random.Random(4)
    rows = [(u - shift, i - shift, float(rnd.randint(1, 5))) for u in range(40) for i in range(30) if rnd.random() < 0.3]
    ratings = spark.createDataFrame(rows, SCHEMA)
    units = cf.vectors(ratings, "item_id")
    near = strips.nearest(units, k=4)
    assert "Exchange" not in near._jdf.queryExecution().executedPlan().toString()
    rounded = lambda df: sorted((r["id"], r["other"], round(r["score"], 9), r["rank"]) for r in df.collect())
    assert rounded(near) == rounded(blocks.nearest(units, k=4))
    for candidates, of in ((cf.item_candidates, "item_id"), (cf.user_candidates, "user_id")):
        near = cf.neighbours(ratings, of, 4)
        sums, taken = {}, {(u, i) for u, i, _ in rows}
        for r in near.collect():
            for user, item, rating in rows:
                if r["other"] == (item if of == "item_id" else user):
                    key = (user, r["id"]) if of == "item_id" else (r["id"], item)
                    if key not in taken:
                        sums.setdefault(key, []).append((r["score"], rating))
        want = {key: sum(s * x for s, x in found) / sum(s for s, _ in found) for key, found in sums.items()}
        assert {(r["user_id"], r["item_id"]): r["predicted"] for r in candidates(near, ratings).collect()} == pytest.approx(want)


def test_a_rated_item_that_no_other_is_near_to_is_left_out(spark):
    near = spark.createDataFrame([(1, 2, 0.5), (3, 2, 0.5)], "id bigint, other bigint, score double")
    ratings = spark.createDataFrame([(9, 1, 4.0), (9, 2, 3.0), (8, 2, 2.0)], SCHEMA)
    got = {(r["user_id"], r["item_id"]): r["predicted"] for r in cf.item_candidates(near, ratings).collect()}
    assert got == {(9, 3): 3.0, (8, 1): 2.0, (8, 3): 2.0}


def test_the_best_of_a_run_keep_their_ties():
    rnd = np.random.default_rng(2)
    left = np.repeat([5, -3, 2**40], [300, 2, 50])
    for score in (rnd.integers(1, 4, len(left)) / 3, rnd.random(len(left)) * 1e12, np.where(rnd.random(len(left)) < 0.5, -np.inf, 2.5), np.full(len(left), np.nan)):
        kept = set(strips._first(left, score, 7).tolist())
        for one in np.unique(left):
            at = np.flatnonzero(left == one)
            best = sorted(-np.round(score[at], 9))[:7]
            assert all(i in kept for i in at if -np.round(score[i], 9) <= best[-1])
