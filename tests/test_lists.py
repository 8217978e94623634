"""Complete candidate lists and defaults against plain Python."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions.scores import clip
from starloom.operators import collaborative as cf, factors, gaps, products, serving

RATINGS = "user_id bigint, item_id bigint, rating double"


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (9.0,), (2.5,)], "x double")
    assert [r[0] for r in df.select(clip(F.col("x"))).collect()] == [None, 1.0, 5.0, 2.5]


def test_unreached_targets_get_the_default(spark):
    train = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0), (2, 2, 5.0), (3, 9, 3.0)], RATINGS)
    targets = spark.createDataFrame([(1, 9, 3.0), (7, 1, 3.0), (1, 77, 3.0)], RATINGS)
    out = cf.predict_by_item(targets, cf.neighbours(train, "item_id", 5), train, F.lit(3.5)).collect()
    assert {r.predicted for r in out} == {3.5} and len(out) == 3


@pytest.mark.parametrize("stretch", [1, 4, 1024])
def test_first_missing_ids(spark, stretch):
    rng = random.Random(stretch)
    catalogue = sorted(rng.sample(range(10_000), 90))
    taken = {u: set(rng.sample(catalogue, size)) for u, size in enumerate([0, 1, 30, 85, 90, 60])}
    taken[6] = set(catalogue[:70])
    pairs = [(u, i) for u, ids in taken.items() for i in ids] * 2 + [(1, 99_999)]
    users = spark.createDataFrame([(u,) for u in taken], "user_id bigint")
    found = defaultdict(set)
    rows = gaps.first_missing(users, spark.createDataFrame(pairs, "user_id bigint, item_id bigint"),
                              spark.createDataFrame([(i,) for i in catalogue * 3], "item_id bigint").repartition(5), 7, stretch)
    for r in rows.collect():
        assert r.item_id not in found[r.user_id]
        found[r.user_id].add(r.item_id)
    for user, ids in taken.items():
        assert sorted(found[user]) == [i for i in catalogue if i not in ids][:7], user


def some_ratings():
    rng = random.Random(4)
    rows = {(rng.randrange(30), rng.randrange(60) * 7): float(rng.randint(1, 5)) for _ in range(220)}
    return [(u, i, r) for (u, i), r in rows.items()]


@pytest.mark.parametrize("of", ["item_id", "user_id"])
def test_lists_rank_every_unrated_item(spark, of):
    rows = some_ratings()
    ratings = spark.createDataFrame(rows, RATINGS)
    near = cf.neighbours(ratings, of, 3)
    reach = cf.item_candidates(near, ratings) if of == "item_id" else cf.user_candidates(near, ratings)
    known = {(r.user_id, r.item_id): r.predicted for r in reach.collect()}
    rated, mean = {(u, i) for u, i, _ in rows}, sum(r for *_, r in rows) / len(rows)
    lists = cf.item_knn_recommendations if of == "item_id" else cf.user_knn_recommendations
    found = defaultdict(list)
    for r in lists(ratings, 3, 12).orderBy("user_id", "rank").collect():
        found[r.user_id].append((r.item_id, round(r.predicted, 9)))
    items = {i for _, i, _ in rows}
    for user in {u for u, *_ in rows}:
        all_of = sorted((-round(known.get((user, i), mean), 9), i) for i in items if (user, i) not in rated)
        assert found[user] == [(i, -s) for s, i in all_of[:12]]
    assert any(s == round(mean, 9) for rows in found.values() for _, s in rows)


def dense_predictions(spark, rows, rank=4):
    """Ratings, item factors, and the reconstructed rating of every pair, cut to the scale."""
    ratings = spark.createDataFrame(rows, RATINGS)
    items, _ = factors.truncated_svd(ratings, k=rank, oversample=6, rounds=3)
    v = {r.id: np.array(r.f) for r in items.collect()}
    u = defaultdict(lambda: np.zeros(rank))
    for user, item, rating in rows:
        u[user] += rating * v[item]
    return ratings, items, {(a, b): min(5.0, max(1.0, float(u[a] @ v[b]))) for a in u for b in v}


def crowded_ratings():
    """Groups of users who rate the same items, so that some reconstructed ratings exceed 1."""
    rng = random.Random(6)
    return [(u, i, float(rng.randint(3, 5))) for u in range(40) for i in range(60) if rng.random() < (0.8 if u % 4 == i % 4 else 0.06)]


def listed(frame, *columns):
    found = defaultdict(list)
    for r in frame.orderBy("user_id", "rank").collect():
        found[r.user_id].append((r.item_id, *[round(r[c], 8) for c in columns]))
    return found


@pytest.mark.parametrize("block, n", [(1024, 12), (7, 12), (7, 30)])
def test_svd_lists_rank_every_unrated_item(spark, monkeypatch, block, n):
    monkeypatch.setattr(products, "BLOCK", block)
    monkeypatch.setattr(products, "GROUP", 3)
    rows = crowded_ratings()
    ratings, items, scores = dense_predictions(spark, rows)
    rated = {(u, i) for u, i, _ in rows}
    found = listed(factors.svd_recommendations(ratings, items, n), "predicted")
    for user in {u for u, *_ in rows}:
        order = sorted((-round(s, 9), i) for (u, i), s in scores.items() if u == user and (u, i) not in rated)[:n]
        assert [i for i, _ in found[user]] == [i for _, i in order]
        assert np.allclose([s for _, s in found[user]], [-s for s, _ in order])
    assert 0 < sum(s > 1 for rows in found.values() for _, s in rows) < sum(map(len, found.values()))


def test_ensemble_of_three_models(spark):
    rows = crowded_ratings()
    ratings, items, svd = dense_predictions(spark, rows)
    rated, mean = {(u, i) for u, i, _ in rows}, sum(r for *_, r in rows) / len(rows)
    models = {"item_knn": cf.item_candidates(cf.neighbours(ratings, "item_id", 2), ratings),
              "user_knn": cf.user_candidates(cf.neighbours(ratings, "user_id", 2), ratings)}
    known = {name: {(r.user_id, r.item_id): r.predicted for r in df.collect()} for name, df in models.items()}
    found = listed(factors.ensemble(models, ratings, items, 15), "item_knn", "user_knn", "svd", "average_prediction")
    for user in {u for u, *_ in rows}:
        cells = []
        for item in {i for _, i, _ in rows}:
            if (user, item) not in rated:
                three = [*[known[name].get((user, item), mean) for name in models], svd[user, item]]
                cells.append((-round(sum(three) / 3, 9), item, *[round(x, 8) for x in (*three, sum(three) / 3)]))
        assert [f[0] for f in found[user]] == [c[1] for c in sorted(cells)[:15]]
        assert np.allclose([f[1:] for f in found[user]], [c[2:] for c in sorted(cells)[:15]])


def test_products_skip_blocks_below_the_floor(spark):
    left = spark.createDataFrame([(i, [float(i), 0.0], 3) for i in range(50)], "id bigint, f array<double>, want bigint")
    right = spark.createDataFrame([(i, [2.0**-i, 1.0]) for i in range(20)] + [(99, [0.0, 0.0])], "id bigint, f array<double>")
    rows = products.largest_products(left, right, 1.0, 30.0).collect()
    want = {(i, j): min(30.0, i * 2.0**-j) for i in range(50) for j in range(20) if i * 2.0**-j > 1}
    best = defaultdict(list)
    for (i, j), s in want.items():
        best[i].append((-s, j))
    got = {(r.id, r.other): r.score for r in rows}
    assert all(got[pair] == want[pair] for pair in got)
    assert {(i, j) for i, scored in best.items() for _, j in sorted(scored)[:3]} <= set(got)
    assert products.largest_products(left, right.where("id = 99"), 1.0).count() == 0


def _spread_plainly(rows, genres):
    """One user's ``(item, predicted, confidence, rank)`` rows in the order of the genre rule."""
    rows = sorted(rows, key=lambda r: r[3])
    long = [(round(p * c, 9), item, genre) for item, p, c, _ in rows for genre in genres.get(item) or () if genre]
    names = list(dict.fromkeys(genre for *_, genre in long))
    if len(rows) <= 5 or not names:
        return [(r[0], r[3]) for r in rows]
    picked = []
    for name in names:
        fresh = [item for _, item, genre in sorted(long, key=lambda x: -x[0]) if genre == name and item not in picked]
        picked += fresh[: max(2, len(rows) // len(names))]
    by_worth = [r[0] for r in sorted(rows, key=lambda r: -round(r[1] * r[2], 9))]
    return list(zip([*picked, *(i for i in by_worth if i not in picked)], range(1, 1000)))


def test_lists_are_spread_without_a_frame_per_user(spark):
    rnd = random.Random(8)
    genres = {i: rnd.choice([None, [], [None, "a"], rnd.sample("abcdef", 3), ["b"]]) for i in range(60)}
    rows = [(u, i, float(rnd.randint(1, 5)), rnd.choice([0.3, 0.6]), rank) for u in range(-3, 30) for rank, i in enumerate(rnd.sample(range(60), rnd.randint(1, 25)), 1)]
    lists = spark.createDataFrame(rows, "user_id bigint, item_id bigint, predicted double, confidence double, rank int")
    items = spark.createDataFrame(list(genres.items()), "item_id bigint, genres array<string>")
    out = serving.diversify(lists, items)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    want = {(u, item): rank for u in range(-3, 30) for item, rank in _spread_plainly([r[1:] for r in rows if r[0] == u], genres)}
    assert {(r["user_id"], r["item_id"]): r["rank"] for r in out.collect()} == want
