"""Structured Streaming jobs over session events.

Answers that depend on the order of a session's events are given in event time:
rows wait in state, one time bucket per map entry, until the watermark has
passed their bucket, and are then answered in order. Files may thus come in any
order, as long as no row is later than the watermark allows. A row beyond the
end of the data, without a session, tells the stream that nothing follows.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Groups of sessions, each with a state of its own.
GROUPS = 256
_NONE = -(1 << 63)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_events(spark: SparkSession, folder: str, name: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """A stream over the Parquet files of one table, which is a file or a folder of files."""
    # a pattern that fits this name only: streams take a single file by a pattern alone
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/[{name[0]}]{name[1:]}")
    )


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings that hold while a stream starts, which takes its own copy of them."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drain(writer) -> None:
    """Runs a stream over all data that is there and waits for it to end."""
    with settings(SparkSession.getActiveSession(), **{"spark.sql.streaming.stateStore.providerClass": STATE_STORE}):
        running = writer.trigger(availableNow=True).start()
    running.awaitTermination()


def running_item_stats(ratings: DataFrame, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Count, sum and mean per item and time window; later rows are dropped."""
    timed = ratings.withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        timed.withWatermark("ts", late)
        .groupBy(F.window("ts", window), "item_id")
        .agg(F.count("*").alias("rating_count"), F.sum("rating").alias("rating_sum"))
        .select(F.col("window.start").alias("window_start"), "item_id", "rating_count", "rating_sum")
    )


def store_updates(stats: DataFrame, folder: str, checkpoint: str):
    """Writes each batch's changed rows under its batch id.

    A repeated batch overwrites its own folder, so a restart after a lost
    executor or driver leaves every update exactly once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return stats.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)


def store_sums(ratings: DataFrame, folder: str, checkpoint: str, window: str = "1 day"):
    """Writes each batch's own counts and sums per item and time window under its batch id.

    Sums of batches add up in any order, so no row is ever too late.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("ts", F.col("ts").cast("timestamp"))
        sums = timed.groupBy(F.window("ts", window), "item_id").agg(
            F.count("*").alias("rating_count"), F.sum("rating").alias("rating_sum"))
        sums = sums.select(F.col("window.start").alias("window_start"), "item_id", "rating_count", "rating_sum")
        sums.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return ratings.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def added_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The sums of all batches of ``store_sums``."""
    stored = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    return stored.groupBy("window_start", "item_id").agg(
        F.sum("rating_count").alias("rating_count"), F.sum("rating_sum").alias("rating_sum"))


def latest_updates(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The last stored row per key."""
    updates = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    values = [c for c in updates.columns if c not in (*keys, "batch")]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("row"))
    return last.select(*keys, "row.*")


class InOrder(StatefulProcessor):
    """Keeps rows until the watermark has passed their bucket, then answers them in order, session by session.

    One state holds a group of sessions, as a call to the state store costs far
    more than a row. A map entry holds the packed rows of one bucket and one
    Arrow batch, so that a timer reads and sorts one bucket at a time, not all
    that waits, and no entry is written twice. What the answers need of earlier
    buckets is packed in one value of ``width`` numbers a row, the session first.
    """

    width = 2

    def __init__(self, seconds: int):
        self.span = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket bigint, part bigint", "packed binary")
        self.parts = handle.getValueState("parts", "n bigint")
        self.kept = handle.getValueState("kept", "packed binary")

    def answer(self, kept: np.ndarray, rows: Iterator[tuple[int, int, int]], end: int) -> tuple[dict[str, list], list[tuple]]:
        """Result columns for ``(session, micros, event)`` in order, and what to keep after ``end``."""
        raise NotImplementedError

    def ended(self, kept: np.ndarray, watermark: int) -> tuple[dict[str, list] | None, np.ndarray]:
        """Result columns for what the watermark alone decides, and what stays."""
        return None, kept

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.parts.get()
        number = known[0] if known is not None else 0
        for part in rows:
            cells = part[["session_id", "micros", "event_id"]].to_numpy("<i8")
            buckets = cells[:, 1] // self.span
            for bucket in np.unique(buckets).tolist():
                self.waiting.updateValue((bucket, number), (cells[buckets == bucket].tobytes(),))
                self.handle.registerTimer((bucket + 1) * self.span // 1000)
            number += 1
        self.parts.update((number,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        ready: dict[int, list[tuple]] = {}
        for entry in self.waiting.keys():
            if (entry[0] + 1) * self.span <= watermark:
                ready.setdefault(entry[0], []).append((entry[0], entry[1]))
        packed = self.kept.get()
        before = kept = np.frombuffer(packed[0] if packed is not None else b"", "<i8").reshape(-1, self.width)
        for bucket in sorted(ready):
            cells = np.concatenate([np.frombuffer(self.waiting.getValue(e)[0], "<i8").reshape(-1, 3) for e in ready[bucket]])
            cells = cells[np.lexsort((cells[:, 2], cells[:, 1], cells[:, 0]))]
            for entry in ready[bucket]:
                self.waiting.removeKey(entry)
            columns, left = self.answer(kept, zip(*cells.T.tolist()), (bucket + 1) * self.span)
            kept = np.array(left, "<i8").reshape(-1, self.width)
            yield self.frame(columns)
        last, kept = self.ended(kept, watermark)
        if last:
            yield self.frame(last)
        if kept is not before:
            self.kept.update((kept.tobytes(),))

    @staticmethod
    def frame(columns: dict[str, list]) -> pd.DataFrame:
        """Result columns as a frame; rows without a session have none there, too."""
        frame = pd.DataFrame(columns)
        return frame.assign(session_id=pd.array([None if s == _NONE else s for s in columns["session_id"]], "Int64"))

    def close(self) -> None:
        pass


class SlidingLimit(InOrder):
    """Admits up to ``limit`` requests per session and window.

    Kept are the admitted times of the last window, at most ``limit`` of a
    session.
    """

    def __init__(self, limit: int, seconds: int):
        super().__init__(seconds)
        self.limit = limit

    def answer(self, kept, rows, end):
        logs: dict[int, deque] = {}
        for session, at in kept.tolist():
            logs.setdefault(session, deque()).append(at)
        sessions, events, allowed = [], [], []
        for session, at, event in rows:
            log = logs.setdefault(session, deque())
            while log and log[0] < at - self.span:
                log.popleft()
            free = len(log) < self.limit
            if free:
                log.append(at)
            sessions.append(session)
            events.append(event)
            allowed.append(free)
        left = [(session, at) for session, log in logs.items() for at in log if at >= end - self.span]
        return {"event_id": events, "session_id": sessions, "allowed": allowed}, left


class AnswerOnce(InOrder):
    """Marks requests that repeat an answer computed less than the time to live ago."""

    def answer(self, kept, rows, end):
        since = dict(kept.tolist())
        sessions, events, answered = [], [], []
        for session, at, event in rows:
            fresh = session not in since or at - since[session] >= self.span
            if fresh:
                since[session] = at
            sessions.append(session)
            events.append(event)
            answered.append(fresh)
        left = [(session, at) for session, at in since.items() if end - at < self.span]
        return {"event_id": events, "session_id": sessions, "answered": answered}, left


class LiveSession(InOrder):
    """Emits a session with its first and last event when it has been quiet for longer than the time to live.

    An event after such a gap starts the session again; a session whose time to
    live the watermark has passed ends without one, and its state is gone.
    """

    width = 4

    def answer(self, kept, rows, end):
        live, ended = {row[0]: row for row in kept.tolist()}, []
        for session, at, _ in rows:
            known = live.get(session)
            if known is not None and at - known[2] > self.span:
                ended.append(known)
                known = None
            live[session] = (session, at, at, 1) if known is None else (session, known[1], at, known[3] + 1)
        return self.rows(ended), list(live.values())

    def ended(self, kept, watermark):
        over = kept[:, 2] + self.span < watermark
        open_ = kept[~over]
        if len(open_):
            self.handle.registerTimer(int(open_[:, 2].min() + self.span) // 1000 + 1)
        return (self.rows(kept[over].tolist()), open_) if over.any() else (None, kept)

    @staticmethod
    def rows(ended) -> dict[str, list]:
        names = {"started": 1, "session_id": 0, "ended": 2, "events": 3}
        return {name: [row[i] for row in ended] for name, i in names.items()}


def with_state(events: DataFrame, processor: StatefulProcessor, schema: str, late: str, groups: int = GROUPS) -> DataFrame:
    """Applies a processor in event time to ``groups`` groups of sessions; rows more than ``late`` behind the newest one are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    # a column with nulls would come as floating numbers; rows without a session are one session
    number = lambda column: F.coalesce(column, F.lit(_NONE))
    timed = timed.select(
        F.pmod(F.xxhash64("session_id"), F.lit(groups)).alias("group"), "ts", number(F.col("session_id")).alias("session_id"),
        number(F.unix_micros("ts")).alias("micros"), number(F.col("event_id")).alias("event_id"),
    )
    return timed.groupBy("group").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="update", timeMode="EventTime"
    )
