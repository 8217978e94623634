"""Splits are exact, also when a group is too big for one task."""

import hashlib
import math
from datetime import datetime, timedelta

import pytest

from starloom.operators import splits


@pytest.fixture(scope="module")
def rows():
    start = datetime(2024, 1, 1)
    out = [(1, i, 3.0, start + timedelta(hours=5 * (i * 37 % 211))) for i in range(200)]
    out += [(u, i, 4.0, start + timedelta(days=(u * i) % 9)) for u in range(2, 12) for i in range(u)]
    return out


@pytest.fixture(scope="module")
def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double, ts timestamp_ntz").cache()


def held_out(df):
    return {(r["user_id"], r["item_id"]) for r in df.where("is_test").collect()}


def by_user(rows):
    users = {}
    for r in rows:
        users.setdefault(r[0], []).append(r)
    return users


@pytest.mark.parametrize("big", [100_000, 20])
def test_user_time_split(ratings, rows, big):
    want = set()
    for user, own in by_user(rows).items():
        if len(own) >= 5:
            own = sorted(own, key=lambda r: (r[3], r[1]))
            want |= {(user, r[1]) for r in own[-max(1, int(len(own) * 0.2)):]}
    assert held_out(splits.user_time_split(ratings, big_group=big)) == want


@pytest.mark.parametrize("big", [100_000, 20])
def test_stratified_split(ratings, rows, big):
    want = set()
    for user, own in by_user(rows).items():
        own = sorted(own, key=lambda r: hashlib.md5(f"{r[0]}_{r[1]}".encode()).hexdigest())
        want |= {(user, r[1]) for r in own[: math.ceil(len(own) * 0.2)]}
    assert held_out(splits.stratified_split(ratings, big_group=big)) == want


@pytest.mark.parametrize("ratio", [0.2, 0.5, 0.93])
def test_temporal_split(ratings, rows, ratio):
    order = sorted(rows, key=lambda r: (r[3], r[0], r[1]))
    want = {(r[0], r[1]) for r in order[int(len(order) * (1 - ratio)):]}
    out = splits.temporal_split(ratings, ratio)
    assert held_out(out) == want and out.count() == len(rows)
