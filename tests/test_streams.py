"""Streams over a table of several files that come in no order, one file per batch."""

from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.operators import sessions
from starloom.plans import registry
from starloom.sources import tables
from starloom.streaming import jobs

SMALL = "/root/testdata/sf0.001"
DAY = 86_400


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """Three files, each with rows of the whole span, read one per batch."""
    tables.table(spark, SMALL, "events").repartition(3, F.xxhash64("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    assert len(list(Path(f"{tmp_path}/events.parquet").glob("part-*"))) == 3
    read = jobs.read_events
    monkeypatch.setattr(jobs, "read_events", lambda *a: read(*a, files_per_batch=1))
    return str(tmp_path)


def requests(spark):
    return tables.sessions(spark, SMALL).select("event_id", "session_id", "ts")


@pytest.mark.parametrize("name", ["i6_sliding_limit_stream", "i12_answered_once_stream"])
def test_order_does_not_depend_on_files(spark, folder, name):
    batch = sessions.sliding_limit(requests(spark), 3, DAY) if name.startswith("i6") else sessions.answered_once(requests(spark), "session_id", DAY)
    want = {tuple(r) for r in batch.collect()}
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    found = registry.QUERIES[name](spark, folder).collect()
    assert {(r["event_id"], r["session_id"], r[2]) for r in found} == want and len(found) == len(want)
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.get("spark.sql.streaming.stateStore.providerClass")) == before


def test_sessions_end_after_a_gap(spark, folder):
    by, want = {}, set()
    for r in requests(spark).orderBy("session_id", "ts", "event_id").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))).collect():
        by.setdefault(r.session_id, []).append(r.at)
    for session, times in by.items():
        start = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] > DAY // 4 * 1_000_000:
                want.add((session, times[start], times[i - 1], i - start))
                start = i
    found = registry.QUERIES["i11_live_session_stream"](spark, folder).select("session_id", "started", "ended", "events").collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want) > len(by)


def test_rows_wait_for_the_watermark(spark, tmp_path):
    """Nothing is answered while an earlier row may still come."""
    requests(spark).write.parquet(f"{tmp_path}/events.parquet")
    stream = jobs.read_events(spark, str(tmp_path), "events.parquet", requests(spark).schema)
    for late, answered in (("365 days", False), ("1 day", True)):
        out = f"{tmp_path}/{late[:3]}"
        result = jobs.with_state(stream, jobs.SlidingLimit(3, DAY), "event_id bigint, session_id bigint, allowed boolean", late)
        jobs.drain(jobs.store_updates(result, out, f"{out}-state"))
        assert (spark.read.parquet(f"{out}/batch=*").count() > 0) == answered


def test_sums_of_many_files(spark, folder):
    one = registry.QUERIES["i15_running_item_stats"](spark, SMALL).collect()
    many = registry.QUERIES["i15_running_item_stats"](spark, folder).collect()
    key = lambda rows: sorted((r["window_start"], r["item_id"] or 0, r["rating_count"], r["rating_sum"]) for r in rows)
    assert key(one) == key(many) and sum(r["rating_count"] for r in many) == tables.sessions(spark, SMALL).count()


class Store:
    """A state store in memory that counts its calls."""

    def __init__(self):
        self.calls, self.data, self.timers = 0, {}, set()

    def getMapState(self, *_):
        return self

    def getValueState(self, name, _):
        return Value(self)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def updateValue(self, key, value):
        self.calls += 1
        self.data[key] = value

    def containsKey(self, key):
        self.calls += 1
        return key in self.data

    def getValue(self, key):
        self.calls += 1
        return self.data[key]

    def removeKey(self, key):
        self.calls += 1
        del self.data[key]

    def keys(self):
        self.calls += 1
        return iter(list(self.data))


class Value:
    def __init__(self, store):
        self.store, self.value = store, None

    def get(self):
        self.store.calls += 1
        return self.value

    def update(self, value):
        self.store.calls += 1
        self.value = value


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_calls_to_the_state_store_follow_buckets_not_sessions():
    n, second = 500, 1_000_000
    for processor, want in ((jobs.SlidingLimit(2, 10), 2 * n), (jobs.AnswerOnce(10), n), (jobs.LiveSession(10), 0)):
        store = Store()
        processor.init(store)
        rows = [(s or jobs._NONE, (t * second) + s % 7, s * 10 + t) for s in range(n) for t in (9, 3, 5)]
        part = pd.DataFrame(rows, columns=["session_id", "micros", "event_id"])
        assert not list(processor.handleInputRows((0,), iter([part]), None))
        out = pd.concat(processor.handleExpiredTimer((0,), Watermark(10_001), None))
        flag = out.columns[-1]
        assert store.calls < 20 and (out["session_id"].isna().sum() == (3 if want else 0)) and (len(out) == 3 * n and out[flag].sum() == want if want else not len(out))
        if not want:  # quiet for longer than the time to live
            last = pd.concat(processor.handleExpiredTimer((0,), Watermark(max(store.timers) + 1), None))
            assert len(last) == n and set(last["events"]) == {3} and (last["ended"] - last["started"] == 6 * second).all()
