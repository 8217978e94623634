"""Factorisation against numpy, streams against their batch twins."""

from collections import deque
from datetime import timedelta

import numpy as np
import pytest

from starloom.operators import factors, sessions
from starloom.plans import registry
from starloom.sources import tables

SMALL = "/root/testdata/sf0.001"


def test_truncated_svd_matches_numpy(spark):
    rng = np.random.default_rng(3)
    dense = (rng.integers(1, 6, (50, 24)) * (rng.random((50, 24)) < 0.4)).astype(float)
    rows = [(int(u), int(i), float(dense[u, i])) for u, i in zip(*np.nonzero(dense))]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    items, singular = factors.truncated_svd(ratings, k=4, oversample=8, rounds=4)
    assert np.allclose(singular, np.linalg.svd(dense, compute_uv=False)[:4], rtol=1e-3)
    v = np.array([r["f"] for r in items.orderBy("id").collect()])
    assert np.allclose(v.T @ v, np.eye(4), atol=1e-6)
    left, s, right = np.linalg.svd(dense, full_matrices=False)
    best = (left[:, :4] * s[:4]) @ right[:4]
    assert np.allclose(dense @ v @ v.T, best, atol=0.1)


def requests(spark):
    return tables.sessions(spark, SMALL).select("event_id", "session_id", "ts")


def in_order(spark):
    by = {}
    for r in requests(spark).orderBy("ts", "event_id").collect():
        by.setdefault(r["session_id"], []).append((r["event_id"], r["ts"]))
    return by


def test_sliding_limit_batch_and_stream(spark):
    want = {}
    for rows in in_order(spark).values():
        log = deque()
        for event, at in rows:
            while log and log[0] < at - timedelta(days=1):
                log.popleft()
            want[event] = len(log) < 3
            if want[event]:
                log.append(at)
    batch = {r["event_id"]: r["allowed"] for r in sessions.sliding_limit(requests(spark), 3, 86_400).collect()}
    stream = {r["event_id"]: r["allowed"] for r in registry.QUERIES["i6_sliding_limit_stream"](spark, SMALL).collect()}
    assert batch == want and stream == want and not all(want.values())


def test_blocked_requests(spark):
    rows = sessions.blocked_requests(requests(spark), 3, 86_400).collect()
    got = {r["event_id"]: r["reason"] for r in rows}
    for events in in_order(spark).values():
        blocked, log = False, []
        for event, at in events:
            log = [t for t in log if t >= at - timedelta(days=1)]
            if blocked:
                assert got[event] == sessions.BLOCKED
            elif len(log) >= 3:
                blocked = True
                assert got[event] == sessions.OVER_LIMIT
            else:
                log.append(at)
                assert got[event] is None


@pytest.mark.parametrize("name", ["i12_answered_once", "i15_running_item_stats", "c3_quality_summary", "e2_item_knn_recommendations", "h8_d7_hybrid_lists"])
def test_query_matches_its_sql(spark, name):
    from oracle_check import compare, duck

    assert compare(spark, duck(SMALL), SMALL, name, registry.QUERIES[name], registry.ORACLES[name]) == ""


@pytest.mark.parametrize("name, model", [("f12_als_test_errors", "als"), ("j7_svd_test_errors", "svd")])
def test_held_out_errors(spark, name, model):
    """The errors are those of the test rows; the mean's are worked out apart."""
    from starloom.plans.collaborative import split_ratings

    train, test = split_ratings(spark, SMALL)
    mean = np.mean([r["rating"] for r in train.select("rating").collect()])
    error = np.array([r["rating"] for r in test.select("rating").collect()]) - mean
    found = {r["model"]: r for r in registry.QUERIES[name](spark, SMALL).collect()}
    assert set(found) == {model, "mean"} and name not in registry.ORACLES
    assert all(r["n"] == len(error) and r["rmse"] >= r["mae"] > 0 for r in found.values())
    assert found["mean"]["rmse"] == pytest.approx(np.sqrt(np.mean(error ** 2)), abs=1e-5)
    assert found[model]["beats_mean"] == (found[model]["rmse"] < found["mean"]["rmse"])


def test_factor_sums_are_plain_sums(spark):
    """Per id plain column sums, which need no sort; a missing rating adds nothing, ids may be null."""
    cells = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0), (2, 2, None), (None, 1, 1.0)], "user_id bigint, item_id bigint, rating double")
    table = spark.createDataFrame([(1, [1.0, 0.5]), (2, [2.0, -1.0])], "id bigint, f array<double>")
    sums = factors._project(cells, table, "user_id", "item_id", 2)
    assert {r["id"]: r["f"] for r in sums.collect()} == {1: [8.0, -2.0], 2: [0.0, 0.0], None: [1.0, 0.5]}
    assert "ObjectHashAggregate" not in sums._jdf.queryExecution().executedPlan().toString()
    assert np.allclose(factors._gram(table, 2), [[5.0, -1.5], [-1.5, 1.25]])
    assert np.allclose(factors._gram(table.where("id > 5"), 2), 0)
    turned = factors._times(table.repartition(4), np.array([[1.0, 2.0, 0.0], [0.0, 4.0, 1.0]]))
    assert {r["id"]: r["f"] for r in turned.collect()} == {1: [1.0, 4.0, 0.5], 2: [2.0, 0.0, -1.0]}
