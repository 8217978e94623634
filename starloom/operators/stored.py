"""Exact nearest vectors over a bounded number of features, without shuffled blocks.

Where every block of one side meets every block of the other, a shuffle writes
each block once per meeting, which is the square of the ids. Here the blocks of
both sides are stored once and the cartesian product of the two scans reads
them again for each meeting, so the disk holds the vectors and the results
only. A task streams the right blocks past a few left ones and keeps the best
of their ids, so its results do not follow the number of blocks either.

The work is still all pairs of ids, but of most only a bound is computed: the
product over the few dimensions that weigh most plus the product of the lengths
of the rest. Only pairs whose bound reaches the floor, or the ``k``-th best so
far, are multiplied out.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from starloom.functions.scores import top_n
from starloom.operators.blocks import _best_cells
from starloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ids and cells of a block at most, if no single vector is longer.
BLOCK_IDS, BLOCK_CELLS = 2048, 1_000_000
#: Dimensions whose products enter the bound one by one.
HEAVY = 16
#: Cells of a dense part of a block.
DENSE = 1 << 24
#: Pairs that are multiplied out at once.
PAIRS = 50_000
#: What rounding may add to a product, against scores that are compared to nine digits.
SLACK = 2e-9

_FIELDS = ("ids", "sizes", "dims", "vals", "taken_sizes", "taken")
SCHEMA = ", ".join(f"{f} binary" for f in _FIELDS)


def cells_of(batches):
    """Ids, dimensions and values of long rows; a missing value is not a number."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(float)


def pack(parts, unit: bool, taken=None, whole: bool = False, add: bool = False):
    """Block rows of ``(ids, dims, vals)`` parts in order of ids; ``taken`` are sorted ids and what they may not be given.

    With ``unit`` vectors are scaled to length one and zero vectors left out,
    with ``whole`` those with a missing value. A dimension that comes twice in
    a vector counts once, or with ``add`` with the sum of its values.
    """
    held, n, cells = [], 0, 0
    for ids, dims, vals in parts:
        if not len(ids):
            continue
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ends = np.r_[starts[1:], len(ids)]
        for a, b in zip(starts.tolist(), ends.tolist()):
            goes_on = bool(held) and held[-1][0][-1] == ids[a]
            if not goes_on and (n >= BLOCK_IDS or (n and cells + b - a > BLOCK_CELLS)):
                yield from _block(held, unit, taken, whole, add)
                held, n, cells = [], 0, 0
            held.append((ids[a:b], dims[a:b], vals[a:b]))
            n, cells = n + (not goes_on), cells + b - a
    if held:
        yield from _block(held, unit, taken, whole, add)


def _block(parts, unit, taken, whole, add):
    ids, dims, vals = (np.concatenate(c) for c in zip(*parts))
    known, row = np.unique(ids, return_inverse=True)
    keep = np.ones(len(known), bool)
    if unit:
        norm = np.sqrt(np.bincount(row, np.where(np.isnan(vals), 0.0, vals) ** 2, len(known)))
        keep = norm > 0
        vals = vals / np.where(keep, norm, 1.0)[row]
    if whole:
        keep[row[np.isnan(vals)]] = False
    order = np.lexsort((dims, row))
    last = np.r_[(row[order][1:] != row[order][:-1]) | (dims[order][1:] != dims[order][:-1]), True]
    at = order[last]
    if add:
        vals = vals.copy()
        vals[at] = np.bincount(np.cumsum(last) - last, vals[order], len(at))
    at = at[keep[row[at]]]
    if not len(at):
        return
    sizes = np.bincount(row[at], minlength=len(known))[keep]
    known, dims = known[keep], dims[at]
    if dims.min() >= -(1 << 31) and dims.max() < 1 << 31:
        dims = dims.astype(np.int32)
    t_sizes, others = np.zeros(len(known), np.int64), np.zeros(0, np.int64)
    if taken is not None:
        first, end = np.searchsorted(taken[0], known, "left"), np.searchsorted(taken[0], known, "right")
        t_sizes = end - first
        others = taken[1][np.repeat(first - (np.cumsum(t_sizes) - t_sizes), t_sizes) + np.arange(t_sizes.sum())]
    columns = (known.astype(np.int64), sizes.astype(np.int64), dims, vals[at], t_sizes.astype(np.int64), others.astype(np.int64))
    yield pa.record_batch([pa.array([c.tobytes()], pa.binary()) for c in columns], names=list(_FIELDS))


def store(vectors: DataFrame, label: str, unit: bool = True, add: bool = False) -> DataFrame:
    """Stored blocks of ``(id, dim, val)`` with whole numbers as dimensions; ``unit`` and ``add`` as in ``pack``."""
    spark = vectors.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(vectors.count() / (4 * BLOCK_CELLS)))
    rows = vectors.where("id IS NOT NULL").select("id", F.col("dim").cast("bigint").alias("dim"), F.col("val").cast("double").alias("val"))
    placed = rows.repartition(tasks, "id").sortWithinPartitions("id", "dim", "val")

    def kernel(batches):
        yield from pack(cells_of(batches), unit, add=add)

    return materialize(placed.mapInArrow(kernel, SCHEMA), label)


def meet(left: DataFrame, right: DataFrame, kernel, schema: str) -> DataFrame:
    """The kernel over all pairs of a stored left and a stored right row, nothing of which is shuffled.

    The pairs of one partition of the left rows follow one another, so joining
    neighbouring partitions gives a task whole stretches of right rows.
    """
    cores = left.sparkSession.sparkContext.defaultParallelism
    tasks = max(left.rdd.getNumPartitions(), 2 * cores)
    named = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    pairs = named(left, "l").crossJoin(named(right, "r").hint("shuffle_replicate_nl"))
    return pairs.coalesce(tasks).mapInArrow(kernel, schema)


def nearest(left: DataFrame, right: DataFrame | None = None, k: int | None = None, min_score: float = 0.0, itself: bool = False, gram=None) -> DataFrame:
    """``(id, other, score[, rank])`` of stored blocks, as ``blocks.nearest``; what the left blocks list as taken is left out.

    An id is its own neighbour only with ``itself``, for sides that hold different things. ``gram`` is a broadcast ``(dims, matrix)`` that the left vectors, without missing values, are multiplied by first.
    """
    def kernel(batches):
        return _nearest_kernel(batches, not itself, k, min_score, gram)

    found = meet(left, left if right is None else right, kernel, "id bigint, other bigint, score double")
    if k is None:
        return found
    return top_n(found, ["id"], k, F.round("score", 9).desc(), F.col("other").asc())


def feature_products(blocks: DataFrame) -> DataFrame:
    """``(a, b, val)``: sums of products of every two features over the vectors; as many rows as squared features.

    A product with a missing value leaves its pair of features out.
    """
    def kernel(batches):
        dims, total = np.zeros(0, np.int64), np.zeros((0, 0))
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(*(batch.column(c)[i].as_buffer() for c in range(4)))
                wider = np.union1d(dims, block.dims)
                if len(wider) > len(dims):
                    at, old = np.searchsorted(wider, dims), total
                    total = np.zeros((len(wider), len(wider)))
                    total[np.ix_(at, at)] = old
                    dims = wider
                step = max(1, DENSE // len(dims))
                for top in range(0, len(block.ids), step):
                    dense = block.dense(dims, slice(top, top + step))
                    missing = np.isnan(dense)
                    if missing.any():
                        present = block.dense(dims, slice(top, top + step), np.ones(len(block.vals)))
                        dense[missing] = 0.0
                        both = missing.T.astype(float) @ present
                        total[(both + both.T) > 0] = np.nan
                    total += dense.T @ dense
        a, b = np.nonzero(total)
        for at in range(0, len(a), 100_000):
            part = slice(at, at + 100_000)
            yield pa.record_batch({"a": dims[a[part]], "b": dims[b[part]], "val": total[a[part], b[part]]})

    parts = blocks.mapInArrow(kernel, "a bigint, b bigint, val double")
    return parts.groupBy("a", "b").agg(F.sum("val").alias("val")).where("val <> 0 AND NOT isnan(val)")


def share_gram(cells: DataFrame):
    """Broadcast ``(dims, matrix)`` of symmetric ``(a, b, val)``; the vocabulary bounds its size."""
    spark = cells.sparkSession
    table = cells.toArrow()
    a, b, val = (table.column(c).to_numpy() for c in ("a", "b", "val"))
    dims = np.union1d(a, b)
    matrix = np.zeros((len(dims), len(dims)))
    matrix[np.searchsorted(dims, a), np.searchsorted(dims, b)] = val
    return spark.sparkContext.broadcast((dims, matrix))


class _Block:
    """Vectors of one stored row."""

    def __init__(self, ids, sizes, dims, vals, taken_sizes=None, taken=b""):
        self.ids, self.sizes, self.vals = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(vals)
        narrow = len(dims) < 8 * len(self.vals)
        self.cell_dims = np.frombuffer(dims, np.int32 if narrow else np.int64).astype(np.int64)
        self.row = np.repeat(np.arange(len(self.ids)), self.sizes)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.dims, self.place = np.unique(self.cell_dims, return_inverse=True)
        self.missing = np.unique(self.place[np.isnan(self.vals)])
        self.taken_row = np.repeat(np.arange(len(self.ids)), np.frombuffer(taken_sizes, np.int64)) if taken_sizes is not None else np.zeros(0, np.int64)
        self.taken = np.frombuffer(taken, np.int64)

    def places(self, dims):
        """Place of every cell in sorted ``dims``, -1 if absent."""
        at = np.minimum(np.searchsorted(dims, self.dims), max(0, len(dims) - 1))
        found = dims[at] == self.dims if len(dims) else np.zeros(len(self.dims), bool)
        return np.where(found, at, -1)[self.place]

    def dense(self, dims, rows, vals=None):
        """Rows of the vectors over sorted ``dims``."""
        a, b = self.starts[rows.start], self.starts[min(rows.stop, len(self.ids))]
        at = self.places(dims)[a:b]
        keep = at >= 0
        out = np.zeros((min(rows.stop, len(self.ids)) - rows.start, len(dims)))
        out[self.row[a:b][keep] - rows.start, at[keep]] = (self.vals if vals is None else vals)[a:b][keep]
        return out


class _Left:
    """A strip of a left block: its dense vectors, what the bound needs, and the best so far."""

    def __init__(self, block: _Block, rows: slice, gram):
        self.block, self.rows = block, rows
        self.ids = block.ids[rows]
        if gram is None:
            self.dims, self.dense = block.dims, block.dense(block.dims, rows)
            self.missing = np.isnan(self.dense)
            self.dense[self.missing] = 0.0
        else:
            self.dims, matrix = gram.value
            self.dense = block.dense(self.dims, rows) @ matrix
            self.missing = np.zeros(self.dense.shape, bool)
        self.all_dims = gram is not None
        energy = np.square(self.dense).sum(axis=0)
        self.heavy = np.sort(np.argsort(-energy, kind="stable")[:HEAVY])
        light = self.dense.copy()
        light[:, self.heavy] = 0.0
        self.bound = np.c_[self.dense[:, self.heavy], np.sqrt(np.square(light).sum(axis=1))]
        self.reach = float(np.sqrt(energy.sum()))


class _Best:
    """The ``k`` best others of the ids of a strip so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.row, self.other, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.least = np.full(len(ids), -np.inf)

    def add(self, row, other, score):
        if not len(row):
            return
        row, other, score = np.r_[self.row, row], np.r_[self.other, other], np.r_[self.score, score]
        order = np.lexsort((other, -np.round(score, 9), row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < self.k
        self.row, self.other, self.score = row[keep], other[order][keep], score[order][keep]
        full = rank[keep] == self.k - 1
        self.least[self.row[full]] = np.round(self.score[full], 9)

    def batches(self):
        yield from _batches(self.ids[self.row], self.other, self.score)


def _batches(ids, others, scores):
    for at in range(0, len(ids), 100_000):
        part = slice(at, at + 100_000)
        yield pa.record_batch({"id": ids[part], "other": others[part], "score": scores[part]})


def _nearest_kernel(batches, same, k, floor, gram):
    best: dict[tuple[int, int], _Best] = {}
    first, strips = None, []
    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            key = np.frombuffer(column["l_ids"][i].as_buffer(), np.int64, 1)[0]
            if key != first:
                block = _Block(*(column[f"l_{f}"][i].as_buffer() for f in _FIELDS))
                width = len(block.dims if gram is None else gram.value[0])
                step = max(1, DENSE // max(1, width))
                first, strips = key, [_Left(block, slice(at, at + step), gram) for at in range(0, len(block.ids), step)]
            right = _Block(*(column[f"r_{f}"][i].as_buffer() for f in _FIELDS[:4]))
            for strip in strips:
                if k is None:
                    row, col, score = _found(strip, right, same, None, np.full(len(strip.ids), floor))
                    yield from _batches(strip.ids[row], right.ids[col], score)
                else:
                    held = best.setdefault((key, strip.rows.start), _Best(strip.ids, k))
                    row, col, score = _found(strip, right, same, k, np.maximum(floor, held.least - SLACK))
                    more = score > floor
                    held.add(row[more], right.ids[col[more]], score[more])
    for held in best.values():
        yield from held.batches()


def _found(left: _Left, right: _Block, same: bool, k: int | None, floors: np.ndarray):
    """Rows, columns and scores of the pairs above the rows' ``floors``, at least the ``k`` best of a row."""
    at = right.places(left.dims)
    cell = np.flatnonzero(at >= 0)
    row, dim, val = right.row[cell], at[cell], np.where(np.isnan(right.vals[cell]), 0.0, right.vals[cell])
    n, m = len(left.ids), len(right.ids)
    place = np.full(len(left.dims), -1)
    place[left.heavy] = np.arange(len(left.heavy))
    is_heavy = place[dim] >= 0
    bound = np.zeros((m, len(left.heavy) + 1))
    bound[row[is_heavy], place[dim[is_heavy]]] = val[is_heavy]
    bound[:, -1] = np.sqrt(np.bincount(row[~is_heavy], np.square(val[~is_heavy]), m))
    most = left.bound @ bound.T
    # rounding of the sums grows with the lengths
    slack = 1e-12 * (1.0 + left.reach * np.sqrt(np.square(val).sum()))
    hidden = _hidden(left, right, same)
    for rows, cols in hidden:
        most[rows, cols] = -np.inf
    wanted = most > (floors - slack)[:, None]
    count = int(np.count_nonzero(wanted))
    sizes = np.bincount(row, minlength=m)
    width = int(sizes.max()) if len(row) else 0
    if count * width * 100 < n * m * len(left.dims):
        i, j = np.nonzero(wanted)
        starts = np.cumsum(sizes) - sizes
        dims, vals = np.zeros((m, width), np.int64), np.zeros((m, width))
        dims[row, np.arange(len(row)) - starts[row]] = dim
        vals[row, np.arange(len(row)) - starts[row]] = val
        score = np.zeros(len(i))
        step = max(1, PAIRS * 20 // max(1, width))
        for a in range(0, len(i), step):
            part = slice(a, a + step)
            score[part] = np.einsum("ij,ij->i", left.dense[i[part][:, None], dims[j[part]]], vals[j[part]])
        keep = score > floors[i]
        return i[keep], j[keep], score[keep]
    scores = np.zeros((n, m))
    step = max(1, DENSE // m)
    for a in range(0, len(left.dims), step):
        dense = right.dense(left.dims[a : a + step], slice(0, m))
        dense[np.isnan(dense)] = 0.0
        scores += left.dense[:, a : a + step] @ dense.T
    for rows, cols in hidden:
        scores[rows, cols] = -np.inf
    scores[scores <= floors[:, None]] = -np.inf
    return _best_cells(right.ids, scores, k, -np.inf)


def _hidden(left: _Left, right: _Block, same: bool):
    """Cells that must not count: an id and itself, what is taken, and pairs that share a dimension with a missing value."""
    order = np.argsort(right.ids)
    ids = right.ids[order]

    def among(others):
        at = np.minimum(np.searchsorted(ids, others), len(ids) - 1)
        return ids[at] == others, order[at]

    out = []
    if same:
        hit, col = among(left.ids)
        out.append((np.flatnonzero(hit), col[hit]))
    block, a = left.block, left.rows.start
    mine = (block.taken_row >= a) & (block.taken_row < a + len(left.ids))
    if mine.any():
        hit, col = among(block.taken[mine])
        out.append((block.taken_row[mine][hit] - a, col[hit]))
    if left.all_dims:  # these vectors have all dimensions
        odd = np.isnan(right.vals) & (right.places(left.dims) >= 0)
        out.append((slice(None), np.unique(right.row[odd])))
    elif left.missing.any() or len(right.missing):
        cells = slice(block.starts[a], block.starts[a + len(left.ids)])
        odd = np.union1d(left.dims[left.missing.any(axis=0)], right.dims[right.missing])
        for dim in odd.tolist():
            l_has = block.row[cells][block.cell_dims[cells] == dim] - a
            r_has = right.row[right.cell_dims == dim]
            at = np.searchsorted(left.dims, dim)
            if not len(l_has) or not len(r_has):
                continue
            l_miss = np.flatnonzero(left.missing[:, at])
            r_miss = right.row[(right.cell_dims == dim) & np.isnan(right.vals)]
            out += [np.ix_(l_miss, r_has), np.ix_(l_has, r_miss)]
    return out
