"""Predictions user by user against block products."""

import random

import pytest

from starloom.operators import asked, blocks, collaborative as cf, content


def _table(df):
    return {(r["user_id"], r["item_id"]): (round(r["num"], 9), round(r["den"], 9)) for r in df.collect()}


@pytest.mark.parametrize("limits", [(1000, 5000, 2_000_000), (8, 5000, 10), (1000, 9, 10), (8, 9, 2_000_000)])
@pytest.mark.parametrize("positive", [False, True])
def test_scores_are_those_of_the_blocks(spark, monkeypatch, limits, positive):
    for name, value in zip(("USER_ROWS", "VECTOR_CELLS", "DENSE"), limits):
        monkeypatch.setattr(asked, name, value)
    rnd = random.Random(5)
    rows = [(u - 9, 7 * i - 5, float(rnd.randint(1, 5))) for u in range(40) for i in range(25) if rnd.random() < 0.2 or i == u % 3]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    targets = ratings.sample(0.6, 1).unionByName(spark.createDataFrame([(0, 2, 1.0), (0, 2, 1.0), (99, 2, 1.0), (0, 10**9, 1.0)], ratings.schema))
    units = cf.vectors(ratings, "item_id")
    if positive:  # vectors of any sign
        units = units.selectExpr("id", "dim", "CASE WHEN dim % 2 = 0 THEN -val ELSE val END * (1 + id % 3) AS val")
    want = _table(blocks.weighted_scores(units, ratings, targets, positive=positive))
    assert _table(asked.weighted_scores(units, ratings, targets, positive)) == want and want


@pytest.mark.parametrize("limits", [(1000, 5000, 2_000_000), (8, 5000, 10), (1000, 9, 10), (8, 9, 2_000_000)])
def test_supporters_are_those_of_the_blocks(spark, monkeypatch, limits):
    for name, value in zip(("USER_ROWS", "VECTOR_CELLS", "DENSE"), limits):
        monkeypatch.setattr(asked, name, value)
    rnd = random.Random(6)
    rows = [(u - 9, 7 * i - 5, float(rnd.randint(1, 5))) for u in range(40) for i in range(25) if rnd.random() < 0.2 or i == u % 3]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    targets = ratings.sample(0.6, 1).unionByName(spark.createDataFrame([(99, 2, 1.0), (0, 10**9, 1.0), (None, 2, 1.0)], ratings.schema))
    units = cf.vectors(ratings, "item_id")
    table = lambda df: sorted((r["user_id"], r["item_id"], r["rank"], r["other"], round(r["score"], 9)) for r in df.collect())
    want = table(blocks.supporters(units, ratings, targets, 2, 0.2))
    found = asked.supporters(units, ratings, targets, 2, 0.2)
    assert table(found) == want and want
    if limits == (1000, 5000, 2_000_000):  # no pairs of blocks
        assert "l_ids" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_predictions_meet_no_blocks(spark):
    ratings = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0), (2, 1, 4.0), (2, 2, 2.0)], "user_id bigint, item_id bigint, rating double")
    out = cf.predict_by_all_items(ratings, ratings)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "l_ids" not in plan
    assert {(r[0], round(r[1], 9)) for r in out.select("user_id", "predicted").collect()} == {(1, 3.0), (1, 5.0), (2, 2.0), (2, 4.0)}


@pytest.mark.parametrize("buffer", [4_000_000, 1, 7])
def test_profiles_are_plain_sums(spark, monkeypatch, buffer):
    monkeypatch.setattr(asked._Users.sums, "__defaults__", (buffer,))
    vectors = spark.createDataFrame([(1, -1, 0.5), (1, 3, 2.0), (2, 3, -1.0), (2, 9, None), (4, 9, 1.0), (2, 3, 0.25)], "id bigint, feature bigint, val double")
    rows = [(7, 1, 4.0), (7, 2, 5.0), (7, 1, 1.0), (8, 2, None), (8, 1, 3.0), (9, 2, None), (None, 1, 2.0), (9, None, 2.0), (10, 99, 1.0), (11, 4, 5.0)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    out = content.user_profiles(ratings, vectors)
    got = {(r["user_id"], r["feature"]): r["val"] for r in out.collect()}
    assert got == {
        (7, -1): pytest.approx(0.5 / 2), (7, 3): pytest.approx((2.0 - 0.75) / 2), (7, 9): None,
        (8, -1): pytest.approx(0.5), (8, 3): pytest.approx(2.0), (8, 9): None, (11, 9): pytest.approx(1.0)}
    assert "ArrowEvalPython" not in out._jdf.queryExecution().optimizedPlan().toString() and "MapInArrow" in out._jdf.queryExecution().optimizedPlan().toString()


def test_cells_that_come_twice_count_once(spark):
    units = spark.createDataFrame([(1, 5, 0.5), (1, 5, 0.5), (1, 6, 0.5), (2, 5, 0.8), (2, 5, 0.8), (2, 6, 0.1)], "id bigint, dim bigint, val double")
    ratings = spark.createDataFrame([(7, 2, 3.0)], "user_id bigint, item_id bigint, rating double")
    targets = spark.createDataFrame([(7, 1)], "user_id bigint, item_id bigint")
    assert _table(asked.weighted_scores(units, ratings, targets)) == {(7, 1): (round(0.45 * 3, 9), 0.45)}
