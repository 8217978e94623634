"""Rate limit and answer-once over whole histories, against one request after the other."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import sessions, splits

SPAN = 60


def history(seed):
    rng, rows, at = random.Random(seed), [], 0
    for event in range(3000):
        # bursts, ties, gaps of exactly the span and longer ones
        at += rng.choice([0, 0, 1, 3, 10, SPAN, SPAN + 1, 500] if event % 100 == 0 else [0, 0, 1, 2, 5, 20])
        rows.append((event, rng.choice([1, 1, 1, 2, 3]), at))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    raw = spark.createDataFrame(rows, "event_id bigint, session_id bigint, s bigint")
    return raw.select("event_id", "session_id", F.timestamp_seconds("s").alias("ts"))


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_limit_matches_a_plain_log(spark, limit):
    rows, want, logs = history(limit), {}, {}
    for event, session, at in sorted(rows, key=lambda r: (r[2], r[0])):
        log = logs.setdefault(session, [])
        want[event] = sum(t >= at - SPAN for t in log) < limit
        if want[event]:
            log.append(at)
    found = sessions.sliding_limit(frame(spark, rows), limit, SPAN).collect()
    assert {r.event_id: r.allowed for r in found} == want and len(found) == len(rows)


def test_answers_match_a_plain_walk(spark):
    rows, want, since = history(9), {}, {}
    for event, session, at in sorted(rows, key=lambda r: (r[2], r[0])):
        want[event] = session not in since or at - since[session] >= SPAN
        if want[event]:
            since[session] = at
    keyed = frame(spark, rows).withColumn("name", F.concat(F.lit("k"), "session_id"))
    found = sessions.answered_once(keyed, "name", SPAN).collect()
    assert {r.event_id: r.answered for r in found} == want and len(found) == len(rows)


def test_one_session_runs_in_several_tasks(spark):
    """A hundred thousand events of one session, with a gap after each thousandth."""
    events = spark.range(100_000).select(
        F.col("id").alias("event_id"), F.lit(7).cast("bigint").alias("session_id"),
        F.timestamp_micros(F.col("id") * 10_000 + F.floor(F.col("id") / 1000) * (SPAN + 1) * 1_000_000).alias("ts"))
    found = sessions.sliding_limit(events, 10, SPAN)
    assert found.where("allowed").count() == 100 * 10
    # so little data would be read by one task otherwise
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        tasks = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.set(key, before)
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 50_000


def test_rows_without_session_or_time(spark):
    rows = frame(spark, [(1, None, 5), (2, None, 5), (3, 4, None), (4, 4, 5), (5, 4, 5)])
    assert {r.event_id: r.allowed for r in sessions.sliding_limit(rows, 1, SPAN).collect()} == {1: True, 2: True, 3: True, 4: True, 5: False}
    assert not sessions.sliding_limit(rows, 0, SPAN).where("allowed").count()
    assert sessions.answered_once(rows.limit(0), "session_id", SPAN).count() == 0


def test_hot_user_is_ranked_in_buckets(spark):
    ratings = spark.range(5000).select(F.lit(1).alias("user_id"), F.col("id").alias("item_id"), F.timestamp_seconds("id").alias("ts"))
    ranked = splits.ranked_within(ratings, "user_id", [F.col("ts")], F.date_format("ts", "yyyy-MM-dd HH"), big_group=100)
    assert ranked.where("pos = item_id + 1 AND n = 5000").count() == 5000
