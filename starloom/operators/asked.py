"""What a user's rated items say of asked ones, a strip of users per task.

Only items of one user are compared, so neither all pairs of items nor their
blocks are multiplied: each strip of users gets the vectors of the items that
its users rated or asked for, once each, and the similarities are formed user by user.
Users with very many rows and very long vectors would make one task long;
their part goes through the block products of :mod:`blocks`.
"""

from __future__ import annotations

import math
import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from starloom.functions.scores import top_n
from starloom.operators import blocks, stored
from starloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vector cells that the requests of a strip reach, counted per request.
CELLS = 6_000_000
#: Rated items of a user, and cells of a vector, beyond which block products are used.
USER_ROWS, VECTOR_CELLS = 1000, 5000
#: Cells of a dense part of a user's vectors.
DENSE = 2_000_000
MAX_STRIPS = 20_000
_SCORES = "user_id bigint, item_id bigint, num double, den double"
_SUPPORT = "user_id bigint, item_id bigint, other bigint, score double, rank int"


def weighted_scores(vectors: DataFrame, history: DataFrame, targets: DataFrame, positive: bool = False) -> DataFrame:
    """``(user_id, item_id, num, den)`` as ``blocks.weighted_scores``, whatever the number of items."""
    parts = _parted(vectors, history, targets, lambda *given: _by_user(*given, positive), lambda h, t: blocks.weighted_scores(vectors, h, t, positive=positive))
    return parts[0] if len(parts) == 1 else _united(parts).groupBy("user_id", "item_id").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))


def supporters(vectors: DataFrame, history: DataFrame, targets: DataFrame, m: int, min_score: float) -> DataFrame:
    """``(user_id, item_id, other, score, rank)`` as ``blocks.supporters``, whatever the number of items."""
    parts = _parted(vectors, history, targets, lambda *given: _closest(*given, m, min_score), lambda h, t: blocks.supporters(vectors, h, t, m, min_score))
    if len(parts) == 1:
        return parts[0]
    return top_n(_united(parts).drop("rank"), ["user_id", "item_id"], m, F.round("score", 9).desc(), F.col("other").asc())


def _united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _parted(vectors: DataFrame, history: DataFrame, targets: DataFrame, by_user, by_blocks) -> list[DataFrame]:
    """Every pair of a rated and an asked item of a user in one of the parts, nearly all in the first."""
    lengths = materialize(vectors.groupBy("id").agg(F.count("*").alias("n")), "lengths")
    long_ids = lengths.where(F.col("n") > VECTOR_CELLS).select(F.col("id").alias("item_id"))
    busy = history.groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") > USER_ROWS).select("user_id")
    busy = busy.unionByName(targets.groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") > USER_ROWS).select("user_id")).distinct()
    busy = materialize(busy, "busy")
    if busy.isEmpty() and long_ids.isEmpty():
        return [by_user(vectors, lengths, history, targets)]
    # a pair of items counts here unless its user or one of the two is left to the blocks
    plain = lambda df: df.join(busy, "user_id", "left_anti")
    short = lambda df: df.join(long_ids, "item_id", "left_anti")
    is_long = lambda df: df.join(long_ids, "item_id", "left_semi")
    apart = targets.join(busy, "user_id", "left_semi").unionByName(is_long(plain(targets)))
    rest = by_user(vectors, lengths, short(plain(history)), short(plain(targets)))
    return [rest, by_blocks(history, apart), by_blocks(is_long(plain(history)), short(plain(targets)))]


def _by_user(vectors: DataFrame, lengths: DataFrame, history: DataFrame, targets: DataFrame, positive: bool) -> DataFrame:
    def kernel(batches):
        strip = _Users(batches)
        out = []
        for user, rows in strip.users():
            out.append(strip.scores(user, rows, positive))
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return _run(vectors, lengths, _requests(history, targets), kernel, _SCORES)


def _closest(vectors: DataFrame, lengths: DataFrame, history: DataFrame, targets: DataFrame, m: int, min_score: float) -> DataFrame:
    def kernel(batches):
        strip = _Users(batches)
        out, held = [], 0
        for user, rows in strip.users():
            out.append(strip.closest(user, rows, m, min_score))
            held += len(out[-1][0])
            if held >= 50_000:
                yield _batch(out, _SUPPORT)
                out, held = [], 0
        if out:
            yield _batch(out, _SUPPORT)

    return _run(vectors, lengths, _requests(history, targets), kernel, _SUPPORT)


def _requests(history: DataFrame, targets: DataFrame) -> DataFrame:
    rated = history.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"), F.lit(True).alias("rated"))
    asked = targets.select("user_id", "item_id", F.lit(None).cast("double").alias("rating"), F.lit(False).alias("rated"))
    return rated.unionByName(asked)


def weighted_sums(vectors: DataFrame, weights: DataFrame) -> DataFrame:
    """``(user_id, dim, sum)``: the sum of weight times vector over a user's items, of ``weights(user_id, item_id, rating)``.

    Missing weights and values are left out; a sum of nothing else is null.
    """
    lengths = materialize(vectors.groupBy("id").agg(F.count("*").alias("n")), "lengths")

    def kernel(batches):
        yield from _Users(batches).sums()

    rows = weights.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"), F.lit(True).alias("rated"))
    return _run(vectors, lengths, rows, kernel, "user_id bigint, dim bigint, sum double")


def weighted_blocks(vectors: DataFrame, weights: DataFrame, label: str, unit: bool = True, mean: bool = False) -> DataFrame:
    """The sums of ``weighted_sums``, with ``mean`` divided by a user's rows, as blocks for ``stored.nearest``.

    They are packed where they are summed; the items of a user go with them as taken.
    A user with a missing sum is left out.
    """
    lengths = materialize(vectors.groupBy("id").agg(F.count("*").alias("n")), "lengths")

    def kernel(batches):
        strip = _Users(batches)
        if len(strip.user):
            users, times = np.unique(strip.user, return_counts=True)
            parts = stored.cells_of(strip.sums())
            if mean:
                parts = ((ids, dims, vals / times[np.searchsorted(users, ids)]) for ids, dims, vals in parts)
            yield from stored.pack(parts, unit, (strip.user, strip.items[strip.vector]), whole=True)

    rows = weights.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"), F.lit(True).alias("rated"))
    return materialize(_run(vectors, lengths, rows, kernel, stored.SCHEMA), label)


def _run(vectors: DataFrame, lengths: DataFrame, requests: DataFrame, kernel, schema: str) -> DataFrame:
    """The kernel over one partition per strip of users, with the vectors of their items."""
    requests = requests.where("user_id IS NOT NULL AND item_id IS NOT NULL")
    counts = requests.groupBy("item_id").agg(F.count("*").alias("asked"))
    reached = counts.join(lengths, counts["item_id"] == lengths["id"]).agg(F.sum(F.col("asked") * F.col("n"))).first()[0] or 0
    cores = requests.sparkSession.sparkContext.defaultParallelism
    strips = min(MAX_STRIPS, max(1, min(2 * cores, math.ceil(reached / 200_000)), math.ceil(reached / CELLS)))
    strip = F.pmod(F.xxhash64("user_id"), F.lit(strips)).cast("int")
    dealt = requests.repartition("item_id").withColumn("strip", strip)
    dealt = dealt.groupBy("item_id", "strip").agg(F.collect_list(F.struct("user_id", F.coalesce("rating", F.lit(math.nan)).alias("rating"), "rated")).alias("r"))
    packed = vectors.repartition("id").groupBy("id").agg(F.collect_list(F.struct("dim", "val")).alias("v"))
    rows = dealt.join(packed, dealt["item_id"] == packed["id"]).select(
        "strip", "item_id", F.col("r.user_id").alias("users"), F.col("r.rating").alias("ratings"), F.col("r.rated").cast("array<int>").alias("rated"),
        F.col("v.dim").alias("dims"), F.col("v.val").alias("vals"))
    return rows.repartitionById(strips, F.col("strip")).drop("strip").mapInArrow(kernel, schema)


def _batch(parts, schema: str = _SCORES) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names)


def _lists(batch, column):
    array = batch.column(column)
    off = array.offsets.to_numpy()
    return np.diff(off), array.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]]


def _summed(users, dims, *values):
    """One row per user and dimension, in order of users."""
    order = np.lexsort((dims, users))
    users, dims = users[order], dims[order]
    first = np.r_[True, (users[1:] != users[:-1]) | (dims[1:] != dims[:-1])]
    place = np.cumsum(first) - 1
    return users[first], dims[first], *[np.bincount(place, v[order]) for v in values]


class _Users:
    """The requests of a strip by user, and its vectors one after the other."""

    def __init__(self, batches):
        items, sizes, cells, asked = [], [], [[], []], [[], [], [], []]
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            items.append(batch.column(0).to_numpy())
            per_row, users = _lists(batch, 1)
            for column, values in zip(asked, (users, _lists(batch, 2)[1], _lists(batch, 3)[1], np.repeat(np.arange(n, n + batch.num_rows), per_row))):
                column.append(values)
            length, dims = _lists(batch, 4)
            sizes.append(length)
            cells[0].append(dims)
            cells[1].append(_lists(batch, 5)[1])
            n += batch.num_rows
        if not n:
            self.user = np.zeros(0, np.int64)
            return
        self.items, self.sizes = np.concatenate(items), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.dims, self.vals = np.concatenate(cells[0]), np.concatenate(cells[1])
        user, rating, rated, vector = (np.concatenate(c) for c in asked)
        order = np.argsort(user, kind="stable")
        self.user, self.rating, self.rated, self.vector = user[order], rating[order], rated[order].astype(bool), vector[order]

    def users(self):
        """Each user and the slice of its requests."""
        if len(self.user):
            starts = np.flatnonzero(np.r_[True, self.user[1:] != self.user[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(self.user)]):
                yield int(self.user[a]), slice(a, b)

    def sums(self, buffer: int = 4_000_000):
        """Batches of users, dimensions and their weighted sums; a user's requests lie in one batch or a part of it is summed before."""
        if not len(self.user):
            return
        ends = np.cumsum(self.sizes[self.vector])
        at, kept = 0, None
        while at < len(self.user):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + buffer, side="right")))
            vector = self.vector[at:to]
            n = self.sizes[vector]
            cell = np.arange(n.sum()) + np.repeat(self.starts[vector] - (np.cumsum(n) - n), n)
            value = np.repeat(self.rating[at:to], n) * self.vals[cell]
            known = ~np.isnan(value)
            parts = [np.repeat(self.user[at:to], n), self.dims[cell], np.where(known, value, 0.0), known.astype(float)]
            if kept is not None:
                parts = [np.concatenate(pair) for pair in zip(kept, parts)]
            users, dims, total, valid = _summed(*parts)
            # the last user may go on
            open_ = users == users[-1] if to < len(self.user) else np.zeros(len(users), bool)
            kept = [c[open_] for c in (users, dims, total, valid)]
            users, dims, total, valid = (c[~open_] for c in (users, dims, total, valid))
            for start in range(0, len(users), 100_000):
                part = slice(start, start + 100_000)
                yield pa.record_batch({"user_id": users[part], "dim": dims[part], "sum": pa.array(total[part], mask=valid[part] == 0)})
            at = to

    def _similarities(self, targets, rated):
        """Dot products of vectors; a cell that comes twice counts once, and dimensions of one vector only are left out."""
        vectors, place = np.unique(np.concatenate([targets, rated]), return_inverse=True)
        n = self.sizes[vectors]
        row = np.repeat(np.arange(len(vectors)), n)
        at = np.arange(n.sum()) + np.repeat(self.starts[vectors] - (np.cumsum(n) - n), n)
        _, column, times = np.unique(self.dims[at], return_inverse=True, return_counts=True)
        shared = times > 1
        column = np.where(shared, np.cumsum(shared) - 1, -1)[column]
        keep = column >= 0
        row, column, value = row[keep], column[keep], self.vals[at[keep]]
        t, r = place[: len(targets)], place[len(targets) :]
        sims = np.zeros((len(t), len(r)))
        width = max(64, DENSE // len(vectors))
        for start in range(0, int(shared.sum()), width):
            part = (column >= start) & (column < start + width)
            dense = np.zeros((len(vectors), min(width, int(shared.sum()) - start)))
            dense[row[part], column[part] - start] = value[part]
            sims += dense[t] @ dense[r].T
        return sims

    def scores(self, user, rows, positive):
        rated, vector = self.rated[rows], self.vector[rows]
        targets, known, rating = vector[~rated], vector[rated], self.rating[rows][rated]
        if not len(targets) or not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        targets, times = np.unique(targets, return_counts=True)
        sims = self._similarities(targets, known)
        sims[targets[:, None] == known[None, :]] = 0.0
        if positive:
            sims = np.where(sims > 1e-9, sims, 0.0)
        num, den = (sims @ rating) * times, np.abs(sims).sum(axis=1) * times  # a target that comes twice counts twice
        keep = den > 0
        return np.full(keep.sum(), user), self.items[targets[keep]], num[keep], den[keep]

    def closest(self, user, rows, m, min_score):
        """Asked items, rated ones and their similarities above ``min_score``, the ``m`` greatest of each asked item."""
        rated, vector = self.rated[rows], self.vector[rows]
        known = vector[rated]
        targets, times = np.unique(vector[~rated], return_counts=True)
        if not len(targets) or not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32)
        sims = self._similarities(targets, known)
        at, other = np.nonzero((sims > min_score) & (self.items[targets][:, None] != self.items[known][None, :]))
        score, other = sims[at, other], self.items[known[other]]
        n = times[at]  # a target that comes twice gets its rows twice
        at, other, score = np.repeat(at, n), np.repeat(other, n), np.repeat(score, n)
        order = np.lexsort((other, -np.round(score, 9), at))
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        keep = rank < m
        order, rank = order[keep], rank[keep]
        return np.full(len(order), user), self.items[targets[at[order]]], other[order], score[order], (rank + 1).astype(np.int32)
