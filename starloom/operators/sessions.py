"""Session analytics: rating patterns, validation, limits and insights.

``ratings`` here holds one row per ``(session_id, item_id)`` with ``rating``.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.scores import half_even
from starloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_RATINGS = 15
MAX_SESSION = 1000
# The insight and refusal texts.
GENEROUS = "You tend to rate movies generously. Recommendations will focus on highly-rated content."
CRITICAL = "You have high standards for movies. Recommendations will emphasize critically acclaimed films."
DIVERSE = "You have diverse taste in movies. Hybrid recommendations will work best for you."
CONSISTENT = "You have consistent rating patterns. Content-based recommendations may work well."
MANY = "With many ratings provided, collaborative filtering will be highly accurate."
FEW = "More ratings will improve recommendation accuracy. Consider rating more movies."
SUSPICIOUS = "Suspicious rating patterns detected"
OVER_LIMIT = "Rate limit exceeded"
BLOCKED = "Session blocked due to suspicious activity"
_LONG_AGO = -(1 << 62)


def rating_patterns(ratings: DataFrame) -> DataFrame:
    """Count, mean, population deviation, range, histogram and flags."""
    mean, std = F.avg("rating"), F.stddev_pop("rating")
    star = F.col("rating").cast("int")
    return ratings.groupBy("session_id").agg(
        F.count("*").alias("total_ratings"),
        half_even(mean, 2).alias("mean_rating"),
        half_even(std, 2).alias("std_rating"),
        (F.max("rating") - F.min("rating")).alias("rating_range"),
        *[F.count_if(star == s).alias(f"stars_{s}") for s in range(1, 6)],
        (mean > 3.5).alias("is_generous_rater"),
        (mean < 2.5).alias("is_critical_rater"),
        F.when(std > 1.0, "high").otherwise("low").alias("rating_variance"),
    )


def confidence(algorithm: str) -> Column:
    """Confidence from the columns of ``rating_patterns``."""
    n = F.col("total_ratings")
    high = F.col("rating_variance") == "high"
    extreme = F.col("is_generous_rater") | F.col("is_critical_rater")
    plus = lambda flag, x: F.when(flag, x).otherwise(0.0)
    base = F.least(F.lit(0.9), 0.4 + (n - MIN_RATINGS) * 0.02)
    total = base + plus(high, 0.1) - plus(extreme, 0.05)
    if algorithm == "collaborative":
        total = total + plus(n > 30, 0.05)
    elif algorithm == "content":
        total = total + plus(high, 0.05)
    return F.when(n < MIN_RATINGS, 0.3).otherwise(F.greatest(F.lit(0.1), F.least(F.lit(0.95), total)))


def consecutive_ids(ratings: DataFrame) -> DataFrame:
    """Per session, how many rated ids directly follow another rated id.

    An equi-join on (session, id) instead of an ordered window, so that a
    session of any size is spread over tasks.
    """
    follows = ratings.select("session_id", (F.col("item_id") + 1).alias("item_id"))
    return ratings.join(follows, ["session_id", "item_id"], "left_semi").groupBy("session_id").agg(F.count("*").alias("sequential"))


def suspicious_flags(ratings: DataFrame) -> DataFrame:
    """The three abuse heuristics and their disjunction."""
    stats = ratings.groupBy("session_id").agg(
        F.count("*").alias("n"), (F.min("rating") == F.max("rating")).alias("one_value")
    )
    joined = stats.join(consecutive_ids(ratings), "session_id", "left")
    n, run = F.col("n"), F.coalesce("sequential", F.lit(0))
    flags = joined.select(
        "session_id",
        "n",
        (n > MAX_SESSION).alias("too_many"),
        (F.col("one_value") & (n > 10)).alias("identical"),
        ((n > 20) & (run > n * 0.8)).alias("sequential_ids"),
    )
    return flags.withColumn("is_suspicious", F.col("too_many") | F.col("identical") | F.col("sequential_ids"))


def validate(ratings: DataFrame) -> DataFrame:
    """``is_valid`` and the first reason (by item id) why a session is refused."""
    item, value = F.col("item_id"), F.col("rating")
    reason = F.when(item <= 0, F.concat(F.lit("Invalid movie ID: "), item.cast("string"))).when(
        ~value.between(1.0, 5.0), F.concat(F.lit("Rating must be between 1.0 and 5.0: "), value.cast("string"))
    )
    rows = ratings.withColumn("reason", reason)
    first = rows.where("reason IS NOT NULL").groupBy("session_id").agg(F.min_by("reason", "item_id").alias("reason"))
    joined = suspicious_flags(ratings).join(first, "session_id", "left")
    why = F.coalesce("reason", F.when(F.col("is_suspicious"), SUSPICIOUS))
    return joined.select("session_id", why.isNull().alias("is_valid"), why.alias("reason"))


def compact(ratings: DataFrame) -> DataFrame:
    """Ratings of a session as arrays in item order, with mean and count, for sessions of every size.

    A session has one latest rating per item, so its arrays are bounded by the catalogue.
    """
    cells = ratings.groupBy("session_id").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "rating"))).alias("cells"),
        F.avg("rating").alias("mean_rating"), F.count("*").alias("rating_count"))
    return cells.select(
        "session_id", F.col("cells.item_id").alias("item_ids"), F.col("cells.rating").alias("ratings"), "mean_rating", "rating_count"
    )


def session_keys(ratings: DataFrame) -> DataFrame:
    """A key of 16 hex digits that depends only on the set of ratings."""
    pairs = F.zip_with(
        "item_ids", "ratings", lambda i, r: F.concat(F.lit('"'), i.cast("string"), F.lit('": '), r.cast("string"))
    )
    text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    return compact(ratings).select("session_id", F.substring(F.sha2(text, 256), 1, 16).alias("session_key"))


def session_records(ratings: DataFrame, algorithm: str) -> DataFrame:
    """Key, pattern and confidence of every session."""
    patterns = rating_patterns(ratings).withColumn("confidence_score", confidence(algorithm))
    return patterns.join(session_keys(ratings), "session_id").withColumn("algorithm_used", F.lit(algorithm))


def insights(patterns: DataFrame) -> DataFrame:
    """Texts for the user and the algorithm to suggest."""
    n = F.col("total_ratings")
    texts = F.array_compact(F.array(
        F.when(F.col("is_generous_rater"), GENEROUS).when(F.col("is_critical_rater"), CRITICAL),
        F.when(F.col("rating_variance") == "high", DIVERSE).otherwise(CONSISTENT),
        F.when(n >= 50, MANY).when(n < 20, FEW),
    ))
    return patterns.select(
        "session_id", texts.alias("insights"), F.when(n >= 25, "hybrid").otherwise("content").alias("recommended_algorithm")
    )


def blocked_requests(requests: DataFrame, limit: int = 100, seconds: int = 3600) -> DataFrame:
    """``requests(event_id, session_id, ts)`` with ``allowed`` and the reason.

    The first request beyond ``limit`` within the window (bounds included) is
    refused and blocks the session for good. Time is cut into buckets as long
    as the window: a row counts in its own bucket and, as context, in the next
    one, so a busy session is counted bucket by bucket in many tasks.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = seconds * 1_000_000
    timed = requests.withColumn("at", micros).withColumn("bucket", F.floor(F.col("at") / span))
    spread = timed.select(
        "session_id", "event_id", "at",
        F.explode(F.array(
            F.struct(F.col("bucket").alias("cell"), F.lit(True).alias("own")),
            F.struct((F.col("bucket") + 1).alias("cell"), F.lit(False).alias("own")),
        )).alias("part"),
    ).select("session_id", "event_id", "at", "part.*")
    recent = Window.partitionBy("session_id", "cell").orderBy("at").rangeBetween(-span, 0)
    counted = spread.withColumn("seen", F.count("*").over(recent)).where("own")
    first = counted.where(F.col("seen") > limit).groupBy("session_id").agg(F.min("at").alias("refused_at"))
    judged = timed.join(first, "session_id", "left")
    open_ = F.col("refused_at").isNull() | (F.col("at") < F.col("refused_at"))
    reason = F.when(open_, None).when(F.col("at") == F.col("refused_at"), OVER_LIMIT).otherwise(BLOCKED)
    return judged.select("event_id", "session_id", open_.alias("allowed"), reason.alias("reason"))


def _pieces(events: DataFrame, key: str, span: int, closed: bool) -> DataFrame:
    """``event_id``, the key, ``at`` (microseconds) and ``piece``, the start of the event's stretch without a gap.

    A gap longer than ``span`` (or as long, if ``closed``) leaves nothing of the
    state before it, so the stretches are independent. Gaps that long lie
    between time buckets of ``span``, so they are found from the first and
    last time per key and bucket: a busy session is one row per bucket there.
    """
    timed = events.select("event_id", key, F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    timed = timed.withColumn("bucket", F.floor(F.col("at") / F.lit(span)))
    edges = timed.groupBy(key, "bucket").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    along = Window.partitionBy(key).orderBy("bucket")
    gap = F.col("first") - F.lag("last").over(along)
    start = F.when(F.coalesce(gap >= span if closed else gap > span, F.lit(True)), F.col("first"))
    starts = edges.withColumn("start", start).select(
        F.col(key).alias("_key"), F.col("bucket").alias("_bucket"), F.max("start").over(along).alias("piece"))
    # stored, so that a hot bucket is a skewed side of a join with a table
    starts = materialize(starts, "pieces")
    joined = timed.join(starts, (F.col(key) == F.col("_key")) & (F.col("bucket") == F.col("_bucket")))
    return joined.select("event_id", key, "at", "piece")


def _granted(events: DataFrame, key: str, limit: int, span: int, closed: bool, name: str) -> DataFrame:
    """``name``: whether an event is granted, when at most ``limit`` granted ones may lie within ``span``.

    Each answer depends on the ones before it in its stretch. A task reads
    stretches as sorted streams; the next ``limit`` grants are found at once,
    each at the first event after the one before it that is also past the end
    of the grant ``limit`` places back. Refused events are jumped over.
    """
    side = "left" if closed else "right"

    def answers(batches):
        last, log = None, np.full(limit, _LONG_AGO)
        places = np.arange(limit)
        for batch in batches:
            at = batch["at"].to_numpy()
            flag = np.zeros(len(at), bool)
            keys, numbers = batch[key].to_numpy(), batch["piece"].to_numpy()
            new = np.ones(len(at), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (numbers[1:] != numbers[:-1])
            starts = np.flatnonzero(new)
            for a, b in zip(starts, np.append(starts[1:], len(at))):
                # a stretch may go on in the next batch
                if (keys[a], numbers[a]) != last:
                    last, log = (keys[a], numbers[a]), np.full(limit, _LONG_AGO)
                times, free = at[a:b], 0
                while free < len(times):
                    floor = np.maximum(np.searchsorted(times, log + span, side), free)
                    next_ = np.maximum.accumulate(floor - places) + places
                    next_ = next_[next_ < len(times)]
                    if not len(next_):
                        break
                    flag[a + next_] = True
                    log = np.concatenate([log[len(next_):], times[next_]])
                    free = int(next_[-1]) + 1
            yield batch[["event_id", key]].assign(**{name: flag})

    events = events.select("event_id", key, "ts")
    whole = F.col(key).isNotNull() & F.col("ts").isNotNull()
    pieces = _pieces(events.where(whole), key, span, closed)
    rows = pieces.repartition(key, "piece").sortWithinPartitions(key, "piece", "at", "event_id")
    key_type = events.schema[key].dataType.simpleString()
    found = rows.mapInPandas(answers, f"event_id bigint, {key} {key_type}, {name} boolean")
    return found.unionByName(events.where(~whole).select("event_id", key, F.lit(True).alias(name)))


def sliding_limit(requests: DataFrame, limit: int = 100, seconds: int = 3600) -> DataFrame:
    """``allowed`` under a sliding log of admitted requests only.

    Refused requests are not logged, so each answer depends on the earlier ones
    back to the last gap longer than ``seconds``. A session is cut there, and its
    stretches are answered by different tasks; each keeps ``limit`` times.
    A request without a session or time is admitted.
    """
    if limit < 1:
        return requests.select("event_id", "session_id", F.lit(False).alias("allowed"))
    span = seconds * 1_000_000
    return _granted(requests, "session_id", limit, span, False, "allowed")


def answered_once(requests: DataFrame, key: str, seconds: int = 3600) -> DataFrame:
    """``answered``: whether a request is computed or repeats an answer still alive.

    An answer lives ``seconds`` from when it was computed; repeats do not renew
    it. A gap that long ends a stretch, as in :func:`sliding_limit`. A request
    without a key or time is computed.
    """
    span = seconds * 1_000_000
    return _granted(requests, key, 1, span, True, "answered")


def expiry(events: DataFrame, ttls: dict[str, int]) -> DataFrame:
    """Live and expired sessions per store at the time of the latest event."""
    last = events.groupBy("session_id").agg(F.max("ts").alias("ts"))
    now = events.agg(F.max("ts")).scalar()
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    stores = F.array(*[F.struct(F.lit(s).alias("store"), F.lit(t * 1_000_000).alias("ttl")) for s, t in ttls.items()])
    rows = last.select(age.alias("age"), F.inline(stores))
    expired = F.col("age") > F.col("ttl")
    return rows.groupBy("store").agg(F.count_if(~expired).alias("live"), F.count_if(expired).alias("expired"))


def session_counts(validated: DataFrame, flags: DataFrame) -> DataFrame:
    return validated.join(flags.select("session_id", "is_suspicious"), "session_id").agg(
        F.count("*").alias("sessions"),
        F.count_if("is_suspicious").alias("suspicious"),
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("refused"),
    )
