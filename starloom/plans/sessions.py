"""Session analytics in batch, and the streams that answer the same questions."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import functions as F

from starloom.operators import sessions as ops
from starloom.plans.base import Group, rounded
from starloom.plans.oracle import cte
from starloom.session import scratch_path
from starloom.sources import tables
from starloom.streaming import jobs

group = Group()
query, QUERIES, ORACLES = group.query, group.queries, group.oracles

LIMIT, DAY = 3, 86_400
TTLS = {"session_cache": 300, "stored_items": 3600, "day": DAY}

cte("patterns", """
SELECT session_id, count(*) AS total_ratings, round_even(round(avg(rating), 9), 2) AS mean_rating, round_even(round(stddev_pop(rating), 9), 2) AS std_rating,
       max(rating) - min(rating) AS rating_range,
       count_if(floor(rating) = 1) AS stars_1, count_if(floor(rating) = 2) AS stars_2, count_if(floor(rating) = 3) AS stars_3,
       count_if(floor(rating) = 4) AS stars_4, count_if(floor(rating) = 5) AS stars_5,
       avg(rating) > 3.5 AS is_generous_rater, avg(rating) < 2.5 AS is_critical_rater,
       CASE WHEN stddev_pop(rating) > 1 THEN 'high' ELSE 'low' END AS rating_variance
FROM session_ratings GROUP BY session_id
""", "session_ratings")
cte("user_ratings_as_sessions", "SELECT user_id AS session_id, item_id, rating, ts FROM ratings", "ratings")
cte("user_patterns", """
SELECT session_id, count(*) AS total_ratings, avg(rating) > 3.5 AS is_generous_rater, avg(rating) < 2.5 AS is_critical_rater,
       CASE WHEN stddev_pop(rating) > 1 THEN 'high' ELSE 'low' END AS rating_variance
FROM user_ratings_as_sessions GROUP BY session_id
""", "user_ratings_as_sessions")
CONFIDENCE = """CASE WHEN total_ratings < 15 THEN 0.3 ELSE greatest(0.1, least(0.95,
  least(0.9, 0.4 + (total_ratings - 15) * 0.02) + CASE WHEN rating_variance = 'high' THEN 0.1 ELSE 0 END
  - CASE WHEN is_generous_rater OR is_critical_rater THEN 0.05 ELSE 0 END {extra})) END"""
COLLABORATIVE = CONFIDENCE.format(extra="+ CASE WHEN total_ratings > 30 THEN 0.05 ELSE 0 END")
CONTENT = CONFIDENCE.format(extra="+ CASE WHEN rating_variance = 'high' THEN 0.05 ELSE 0 END")
HYBRID = CONFIDENCE.format(extra="")


def latest(spark, folder):
    return tables.latest_session_ratings(tables.sessions(spark, folder))


def user_sessions(spark, folder):
    """All ratings of a user as one long session."""
    return tables.ratings(spark, folder).withColumnRenamed("user_id", "session_id")


def requests(spark, folder):
    return tables.sessions(spark, folder).select("event_id", "session_id", "ts")


cte("keys", """
SELECT session_id, substr(sha256('{' || string_agg('"' || item_id || '": ' || CAST(rating AS VARCHAR), ', ' ORDER BY item_id) || '}'), 1, 16) AS session_key
FROM session_ratings GROUP BY session_id
""", "session_ratings")


@query("i1_session_keys", "SELECT session_id, session_key FROM keys", "keys")
def _(spark, folder):
    return ops.session_keys(latest(spark, folder))


@query("i2_rating_patterns", "SELECT * FROM patterns", "patterns")
def _(spark, folder):
    return ops.rating_patterns(latest(spark, folder))


@query("i3_confidence", f"""
SELECT session_id, round(CAST({COLLABORATIVE} AS DOUBLE), 6) AS collaborative, round(CAST({CONTENT} AS DOUBLE), 6) AS content,
       round(CAST({HYBRID} AS DOUBLE), 6) AS hybrid FROM user_patterns
""", "user_patterns")
def _(spark, folder):
    patterns = ops.rating_patterns(user_sessions(spark, folder))
    names = ["collaborative", "content", "hybrid"]
    return rounded(patterns.select("session_id", *[ops.confidence(a).alias(a) for a in names]), *names)


cte("flags", """
SELECT session_id, count(*) AS n, count(*) > 1000 AS too_many, count(DISTINCT rating) = 1 AND count(*) > 10 AS identical,
       count(*) > 20 AND count_if(item_id = previous + 1) > count(*) * 0.8 AS sequential_ids
FROM (SELECT *, lag(item_id) OVER (PARTITION BY session_id ORDER BY item_id) AS previous FROM session_ratings) GROUP BY session_id
""", "session_ratings")
cte("validated", """
SELECT f.session_id, reason IS NULL AND NOT (too_many OR identical OR sequential_ids) AS is_valid,
       coalesce(reason, CASE WHEN too_many OR identical OR sequential_ids THEN 'Suspicious rating patterns detected' END) AS reason
FROM flags f LEFT JOIN (
  SELECT session_id, min_by(reason, item_id) AS reason FROM (
    SELECT session_id, item_id, CASE WHEN item_id <= 0 THEN 'Invalid movie ID: ' || item_id
      WHEN NOT rating BETWEEN 1 AND 5 THEN 'Rating must be between 1.0 and 5.0: ' || rating END AS reason FROM session_ratings)
  WHERE reason IS NOT NULL GROUP BY session_id) r USING (session_id)
""", "flags", "session_ratings")


@query("i4_session_validation", "SELECT session_id, is_valid, reason FROM validated", "validated")
def _(spark, folder):
    return ops.validate(latest(spark, folder))


@query("i5_suspicious_flags", """
SELECT session_id, n, too_many, identical, sequential_ids, too_many OR identical OR sequential_ids AS is_suspicious FROM flags
""", "flags")
def _(spark, folder):
    return ops.suspicious_flags(latest(spark, folder))


@query("e12_consecutive_ids", """
SELECT session_id, count(*) AS sequential FROM (
  SELECT *, lag(item_id) OVER (PARTITION BY session_id ORDER BY item_id) AS previous FROM session_ratings)
WHERE item_id = previous + 1 GROUP BY session_id
""", "session_ratings")
def _(spark, folder):
    return ops.consecutive_ids(latest(spark, folder))


KEPT = f"list_filter(w.log, lambda t: t >= e.micros - {DAY * 1_000_000})"


@query("i6_sliding_limit", f"""
SELECT * FROM (WITH RECURSIVE e AS (
  SELECT event_id, session_id, epoch_us(ts) AS micros, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS step FROM sessions),
walk AS (
  SELECT event_id, session_id, step, [micros] AS log, TRUE AS allowed FROM e WHERE step = 1
  UNION ALL
  SELECT e.event_id, e.session_id, e.step, CASE WHEN len({KEPT}) < {LIMIT} THEN list_append({KEPT}, e.micros) ELSE {KEPT} END, len({KEPT}) < {LIMIT}
  FROM walk w JOIN e ON e.session_id = w.session_id AND e.step = w.step + 1)
SELECT event_id, session_id, allowed FROM walk)
""", "sessions")
def _(spark, folder):
    return ops.sliding_limit(requests(spark, folder), LIMIT, DAY)


@query("i7_blocked_requests", f"""
SELECT event_id, session_id, blocked = 0 AS allowed,
       CASE WHEN blocked = 0 THEN NULL WHEN blocked = 1 AND flagged THEN 'Rate limit exceeded' ELSE 'Session blocked due to suspicious activity' END AS reason
FROM (SELECT *, sum(CAST(flagged AS INTEGER)) OVER (PARTITION BY session_id ORDER BY ts) AS blocked FROM (
  SELECT event_id, session_id, ts,
         count(*) OVER (PARTITION BY session_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) > {LIMIT} AS flagged FROM sessions))
""", "sessions")
def _(spark, folder):
    return ops.blocked_requests(requests(spark, folder), LIMIT, DAY)


@query("i8_session_records", f"""
SELECT p.session_id, session_key, total_ratings, mean_rating, std_rating, rating_variance, is_generous_rater, is_critical_rater,
       round(CAST({HYBRID} AS DOUBLE), 6) AS confidence_score, 'hybrid' AS algorithm_used
FROM patterns p JOIN keys USING (session_id)
""", "patterns", "keys")
def _(spark, folder):
    columns = ["session_id", "session_key", "total_ratings", "mean_rating", "std_rating", "rating_variance",
               "is_generous_rater", "is_critical_rater", "confidence_score", "algorithm_used"]
    return rounded(ops.session_records(latest(spark, folder), "hybrid").select(columns), "confidence_score")


@query("i9_compact_sessions", """
SELECT session_id, string_agg(item_id, ',' ORDER BY item_id) AS item_ids, string_agg(CAST(rating AS VARCHAR), ',' ORDER BY item_id) AS ratings,
       round(avg(rating), 6) AS mean_rating, count(*) AS rating_count
FROM session_ratings GROUP BY session_id
""", "session_ratings")
def _(spark, folder):
    df = ops.compact(latest(spark, folder))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return rounded(df.select("session_id", text("item_ids"), text("ratings"), "mean_rating", "rating_count"), "mean_rating")


@query("i11_expiry", """
SELECT store, count_if(epoch_us(now) - epoch_us(ts) <= ttl * 1000000::BIGINT) AS live, count_if(epoch_us(now) - epoch_us(ts) > ttl * 1000000::BIGINT) AS expired
FROM (SELECT session_id, max(ts) AS ts FROM sessions GROUP BY session_id) CROSS JOIN (SELECT max(ts) AS now FROM sessions)
CROSS JOIN (VALUES ('session_cache', 300), ('stored_items', 3600), ('day', 86400)) t(store, ttl) GROUP BY store
""", "sessions")
def _(spark, folder):
    return ops.expiry(tables.sessions(spark, folder), TTLS)


@query("i12_answered_once", """
WITH RECURSIVE e AS (SELECT event_id, session_id, ts FROM sessions),
chain AS (
  SELECT session_id, min(ts) AS ts FROM e GROUP BY session_id
  UNION ALL
  SELECT c.session_id, (SELECT min(e.ts) FROM e WHERE e.session_id = c.session_id AND e.ts >= c.ts + INTERVAL 1 DAY)
  FROM chain c WHERE c.ts IS NOT NULL)
SELECT e.event_id, e.session_id, c.ts IS NOT NULL AS answered FROM e LEFT JOIN chain c ON c.session_id = e.session_id AND c.ts = e.ts
""".replace("sessions)", "(SELECT event_id, user_id AS session_id, ts FROM events))", 1))
def _(spark, folder):
    return ops.answered_once(requests(spark, folder), "session_id", DAY)


@query("i13_session_counts", """
SELECT count(*) AS sessions, count_if(too_many OR identical OR sequential_ids) AS suspicious, count_if(is_valid) AS valid, count_if(NOT is_valid) AS refused
FROM validated JOIN flags USING (session_id)
""", "validated", "flags")
def _(spark, folder):
    ratings = latest(spark, folder)
    return ops.session_counts(ops.validate(ratings), ops.suspicious_flags(ratings))


@query("i14_insights", f"""
SELECT session_id, concat_ws('|', CASE WHEN is_generous_rater THEN '{ops.GENEROUS}' WHEN is_critical_rater THEN '{ops.CRITICAL}' END,
       CASE WHEN rating_variance = 'high' THEN '{ops.DIVERSE}' ELSE '{ops.CONSISTENT}' END,
       CASE WHEN total_ratings >= 50 THEN '{ops.MANY}' WHEN total_ratings < 20 THEN '{ops.FEW}' END) AS insights,
       CASE WHEN total_ratings >= 25 THEN 'hybrid' ELSE 'content' END AS recommended_algorithm
FROM user_patterns
""", "user_patterns")
def _(spark, folder):
    df = ops.insights(ops.rating_patterns(user_sessions(spark, folder)))
    return df.withColumn("insights", F.array_join("insights", "|"))


# ---- streams

def event_stream(spark, folder):
    """The session events as a stream over the same file."""
    raw = tables.table(spark, folder, "events")
    stream = jobs.read_events(spark, folder, "events.parquet", raw.schema)
    return tables.session_columns(stream)


def run_stateful(spark, folder, processor, schema, label, keys):
    """All rows that a processor emits for the whole table, whose files may come in any order."""
    out, state, ends = (scratch_path(spark, f"{label}{part}") for part in ("", "-state", "-end"))
    raw = tables.sessions(spark, folder).select("event_id", "session_id", "ts")
    first, last = raw.agg(F.min("ts"), F.max("ts")).first()
    span = last - first if first is not None else timedelta(0)
    raw.limit(0).write.parquet(ends)

    def run():
        end = spark.readStream.schema(raw.schema).parquet(ends)
        events = event_stream(spark, folder).select("event_id", "session_id", "ts").unionByName(end)
        # any file may hold the first row of the table or the last
        result = jobs.with_state(events, processor, schema, f"{math.ceil(span.total_seconds()) + 1} seconds")
        jobs.drain(jobs.store_updates(result, out, state))

    run()
    if first is not None:  # nothing follows: the watermark may pass every row
        after = last + 2 * (span + timedelta(seconds=1)) + timedelta(microseconds=4 * processor.span)
        spark.createDataFrame([(None, None, after)], raw.schema).write.mode("append").parquet(ends)
        run()
    return jobs.latest_updates(spark, out, keys)


@query("i6_sliding_limit_stream", ORACLES["i6_sliding_limit"])
def _(spark, folder):
    return run_stateful(spark, folder, jobs.SlidingLimit(LIMIT, DAY), "event_id bigint, session_id bigint, allowed boolean", "limit", ["event_id"])


@query("i12_answered_once_stream", ORACLES["i12_answered_once"])
def _(spark, folder):
    return run_stateful(spark, folder, jobs.AnswerOnce(DAY), "event_id bigint, session_id bigint, answered boolean", "answers", ["event_id"])


@query("i11_live_session_stream", f"""
SELECT session_id, min(epoch_us(ts)) AS started, max(epoch_us(ts)) AS ended, count(*) AS events FROM (
  SELECT *, sum(starts) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS piece FROM (
    SELECT event_id, session_id, ts,
      CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id)) <= {DAY // 4} * 1000000::BIGINT THEN 0 ELSE 1 END AS starts
    FROM sessions))
GROUP BY session_id, piece
""", "sessions")
def _(spark, folder):
    schema = "started bigint, session_id bigint, ended bigint, events bigint"
    return run_stateful(spark, folder, jobs.LiveSession(DAY // 4), schema, "live", ["session_id", "started"])


@query("i15_running_item_stats", """
SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, item_id, count(*) AS rating_count, sum(rating) AS rating_sum
FROM sessions GROUP BY ALL
""", "sessions")
def _(spark, folder):
    out, state = scratch_path(spark, "stats"), scratch_path(spark, "stats-state")
    jobs.drain(jobs.store_sums(event_stream(spark, folder), out, state))
    stats = jobs.added_sums(spark, out)
    return stats.withColumn("window_start", F.unix_seconds("window_start"))
