"""Exact products of sparse tables, a strip of left ids per task.

Cells are ``(id, dim, val)`` on both sides. The left ids are hashed into
strips; a left cell meets the whole right row of its dimension, so all partial
products of a left id lie in one task, are summed there, and only what is asked
for leaves it. Against :mod:`blocks`, which multiplies all pairs of blocks, the
work is the number of products, and the best of an id need no second shuffle:
this is the way for cells as sparse as ratings, not for dense features.

The number of strips follows the number of products. A strip's sums are
compacted as they come, so a left id costs at most the ids it meets, and the
rows of a hot dimension are cut into chunks.

Whole rows are not shuffled to the strips that need them, which would write
each right cell once per product. They are stored once, packed, and each task
reads them all for a few strips: of the left cells only its own, of the right
ones the rows that these meet. The disk holds the cells and the results, reading
grows with cells times tasks.

Where a table meets itself and only pairs above a cosine are wanted, each pair
is multiplied once, and what a strip needs travels packed: plain values, which
repeat, instead of unit ones, and a coarse length, which is enough to drop most
pairs in the task. The exact length is joined to the few that are left.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Products of a strip, and of a buffer before it is summed up.
PRODUCTS = 4_000_000
#: Cells of a chunk of a right row.
CHUNK = 1024
#: Products per cell up to which strips are used for nearest ids.
LIGHT = 500
MAX_STRIPS = 20_000
#: Cells of a stored row, and strips of one sum a pair that share one reading of all of them; those of more sums are half as many.
STORED = 1_000_000
SHARED = 4

#: Steps of a coarse length per factor of two.
STEPS = 16

_LOW = 32
#: The arrays of a packed part, per group (0), left cell (1) and right cell (2): numbers of cells, then ids, values
#: and coarse lengths for pairs.
PAIRS = ((0, "i4"), (0, "i4"), (1, "i8"), (1, "f8"), (1, "i2"), (2, "i8"), (2, "f8"), (2, "i2"))
#: The arrays of a stored row: of its rows the dimension, if it is left out, and the number of right cells, then these;
#: and of a task's left cells the row and number of each group, then the cells.
RIGHT = ("i8", "i1", "i4", "i8", "f8")
LEFT = ("i4", "i4", "i8", "f8")


def products(left: DataFrame, right: DataFrame) -> tuple[int, ...]:
    """Products of the two tables, their cells, the longest right and left row, and the least and greatest right id."""
    met = right.groupBy("dim").agg(F.count("*").alias("r"), F.min("id").alias("low"), F.max("id").alias("high"))
    sizes = left.groupBy("dim").agg(F.count("*").alias("l")).join(met, "dim")
    found = sizes.agg(F.sum(F.col("l") * F.col("r")), F.sum(F.col("l") + F.col("r")), F.max("r"), F.max("l"), F.min("low"), F.max("high"))
    return tuple(n or 0 for n in found.first())


def _count(df: DataFrame, total: float) -> int:
    """Strips for so many products."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(MAX_STRIPS, max(1, min(2 * cores, math.ceil(total / 200_000)), math.ceil(total / PRODUCTS)))


def _chunked(df: DataFrame, longest: int) -> tuple[DataFrame, Column]:
    """Only rows longer than a chunk are cut."""
    if longest <= CHUNK:
        return df, F.lit(0)
    long_rows = df.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    long_rows = long_rows.select("dim", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    return df.join(long_rows, "dim", "left"), F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1)))


def _rows(cells: DataFrame, longest: int, *values: str) -> DataFrame:
    """``(dim, cells)``: all cells of a dimension, or of a chunk of it."""
    cells, chunk = _chunked(cells.where("dim IS NOT NULL"), longest)
    return cells.repartition("dim").withColumn("chunk", chunk).groupBy("dim", "chunk").agg(F.collect_list(F.struct("id", *values)).alias("cells"))


def _packed(rows: DataFrame, strips: int, kernel, schema: str) -> DataFrame:
    """The kernel over one partition per strip, which gets what it needs of rows ``(dim, cells, others)`` as parts."""
    names = [("id", "bigint"), ("val", "double"), ("code", "smallint")]
    rows = rows.select("dim", *[F.col(f"{side}.{name}").cast(f"array<{kind}>").alias(f"{side}_{name}") for side in ("cells", "others") for name, kind in names])

    def deal(batches):
        for batch in batches:
            yield from _dealt(batch.column(0).to_numpy(), [_Strip._lists(batch, c) for c in range(1, batch.num_columns)], PAIRS, strips)

    dealt = rows.mapInArrow(deal, "strip int, sizes array<int>, parts array<binary>")
    return dealt.repartitionById(strips, F.col("strip")).select("sizes", "parts").mapInArrow(kernel, schema)


def _read(rows: DataFrame, strips: int, n: int, weight: str, direct: bool, finish, schema: str) -> DataFrame:
    """What ``finish`` returns of the sums of each strip of rows ``(dim, cells, others, own)``, which are stored and read by every task."""
    spark = rows.sparkSession
    shared = min(SHARED // min(n, 2), max(1, strips // (2 * spark.sparkContext.defaultParallelism)))
    tasks = math.ceil(strips / shared)
    cells = lambda side: [F.col(f"{side}.{name}").cast(f"array<{kind}>").alias(f"{side}_{name}") for name, kind in (("id", "bigint"), ("val", "double"))]
    rows = rows.select("dim", F.col("own").cast("tinyint").alias("own"), *cells("cells"), *cells("others"))

    def pack(batches):
        yield from _stored(batches, tasks, shared)

    def kernel(batches):
        held = [_Strip(n, weight, direct) for _ in range(shared)]
        for batch in batches:
            for i in range(batch.num_rows):
                _meet(held, batch, i)
        while held:
            yield from finish(held.pop())

    stored = materialize(rows.mapInArrow(pack, "sizes array<int>, others array<binary>, groups array<array<int>>, parts array<array<binary>>"), "rows")
    # the first side of a cartesian product is streamed, so a task reads all stored rows for its part of each
    task = spark.range(0, tasks, 1, tasks).select(F.col("id").cast("int").alias("task")).hint("shuffle_replicate_nl")
    own = [F.get(side, F.col("task")).alias(side) for side in ("groups", "parts")]
    return stored.coalesce(1).crossJoin(task).select("sizes", "others", *own).mapInArrow(kernel, schema)


def nearest(left: DataFrame, right: DataFrame | None = None, k: int | None = None, min_score: float = 0.0, sizes=None) -> DataFrame:
    """``(id, other, score[, rank])``: as ``blocks.nearest`` for a ``min_score`` of 0 or more."""
    same = right is None
    total, _, longest, left_longest, low, high = sizes or products(left, left if same else right)
    rows = _rows(left, left_longest, "val")
    # chunks of a long row meet each other, a whole one itself
    if same and longest <= CHUNK:
        rows = rows.withColumn("others", F.col("cells"))
    else:
        rows = rows.join((rows if same else _rows(right, longest, "val")).select("dim", F.col("cells").alias("others")), "dim")

    def finish(strip):
        left, right, (score,) = strip.sums()
        keep = score > min_score
        if same:
            keep &= left != right
        yield from _ranked(left[keep], right[keep], score[keep], k, {"score": score[keep]})

    schema = "id bigint, other bigint, score double" + ("" if k is None else ", rank int")
    return _read(rows.withColumn("own", F.lit(False)), _count(left, total), 1, "", _direct(low, high), finish, schema)


def _direct(low: int, high: int) -> bool:
    """Whether right ids are their own places."""
    return low >= 0 and high < 1 << _LOW


def above(cells: DataFrame, norms: DataFrame, min_score: float, sizes=None) -> DataFrame:
    """``(id, other, score)``, both ways, for all pairs with a cosine above ``min_score``, which is positive.

    ``cells`` are ``(id, dim, val, norm)`` with the finite, positive length of
    the id's vector, which ``norms(id, norm)`` lists again.
    """
    total, _, longest, *_ = sizes or products(cells, cells)
    rows = _rows(cells.withColumn("code", F.floor(F.log2("norm") * STEPS).cast("short")), longest, "val", "code")
    # chunks of a long row meet each other, a whole one itself
    rows = rows.withColumn("others", F.col("cells")) if longest <= CHUNK else rows.join(rows.select("dim", F.col("cells").alias("others")), "dim")

    def kernel(batches):
        strip = _Strip(1)
        for batch in batches:
            strip.add_packed(batch)
        left, right, dot, least = strip.dots()
        # lengths are rounded down, so nothing above is lost; NaN is not above
        keep = dot > min_score * (1 - 1e-9) * least
        yield from _ranked(left[keep], right[keep], dot[keep], None, {"dot": dot[keep]})

    found = _packed(rows, _count(cells, total / 2), kernel, "id bigint, other bigint, dot double")
    length = lambda key: norms.select(F.col("id").alias(key), F.col("norm").alias(f"{key}_norm"))
    scored = found.join(length("id"), "id").join(length("other"), "other").withColumn("score", F.col("dot") / (F.col("id_norm") * F.col("other_norm")))
    ways = F.array(F.struct("id", "other"), F.struct(F.col("other").alias("id"), F.col("id").alias("other")))
    return scored.where(F.col("score") > min_score).select(F.explode(ways).alias("pair"), "score").select("pair.id", "pair.other", "score")


def means(left: DataFrame, right: DataFrame, exclude: DataFrame | None, weight: str, n: int | None = None, low: float = -math.inf, high: float = math.inf) -> DataFrame:
    """``(id, other, score, support)``: the mean of one side's values weighted by the other's, over the ``support`` shared dimensions.

    ``weight`` names the side, ``left`` or ``right``, whose values weigh.
    Means lie within ``low`` and ``high``, ``exclude`` lists ``(id, other)``
    pairs to leave out; None leaves out an id's own dimensions. With ``n`` only the best of each id are returned,
    equal ones (to nine digits) by id. A missing value adds its weight alone;
    a mean without any value is null. Cells without an id are left out.
    """
    left, right = left.where("id IS NOT NULL"), right.where("id IS NOT NULL")
    total, _, longest, left_longest, least, most = products(left, right)
    own = exclude is None
    others = _rows(right, longest, "val").select("dim", F.col("cells").alias("others"))
    # an id's own dimension is left out where no right cell has it, too
    rows = _rows(left, left_longest, "val").join(others, "dim", "left" if own else "inner").withColumn("own", F.lit(own))
    if not own:
        taken = exclude.where("id IS NOT NULL").select("id", F.col("other").alias("dim"), F.lit(None).cast("double").alias("val"))
        rows = rows.unionByName(_rows(taken, sys.maxsize, "val").withColumn("own", F.lit(True)), allowMissingColumns=True)

    def finish(strip):
        left, right, (num, den, valid, support) = strip.sums()
        known = valid > 0
        score = np.full(len(num), -np.inf)
        np.divide(num, den, out=score, where=known)
        score[known] = np.clip(score[known], low, high)
        yield from _ranked(left, right, score, n, {"score": pa.array(score, mask=~known), "support": support.astype(np.int64)}, ranked=False)

    schema = "id bigint, other bigint, score double, support bigint"
    return _read(rows, _count(left, total), 4, weight, _direct(least, most), finish, schema)


def _ranked(left, right, score, k, columns, ranked=True):
    """Result batches; with ``k`` the first of each left id by score to nine digits and right id."""
    at = np.arange(len(left))
    extra = {}
    if k is not None and len(left):
        first = _first(left, score, k)
        left, right, score = left[first], right[first], score[first]
        columns = {name: pa.array(values).take(pa.array(first)) for name, values in columns.items()}
        order = np.lexsort((right, -np.round(score, 9), left))
        ids = left[order]
        rank = np.arange(len(ids)) - np.searchsorted(ids, ids, side="left")
        at = order[rank < k]
        if ranked:
            extra["rank"] = pa.array(rank[rank < k] + 1, pa.int32())
    elif k is not None and ranked:
        extra["rank"] = pa.array([], pa.int32())
    columns = {name: pa.array(values).take(pa.array(at)) for name, values in columns.items()}
    whole = pa.record_batch({"id": pa.array(left[at]), "other": pa.array(right[at]), **columns, **extra})
    for start in range(0, whole.num_rows, 100_000):
        yield whole.slice(start, 100_000)


def _dealt(dims, lists, kinds, strips):
    """Batches ``(strip, sizes, parts)`` of rows with left and right cells: a strip's left cells with the right ones of greater ids."""
    half = len(lists) // 2
    l_off, r_off = lists[0][0], lists[half][0]
    ends = np.cumsum(np.diff(l_off).astype(np.int64) * np.diff(r_off))
    at = 0
    while at < len(ends):  # rows whose products fill a buffer
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PRODUCTS, side="right")))
        left, right = [v[l_off[at] : l_off[to]] for _, v in lists[:half]], [v[r_off[at] : r_off[to]] for _, v in lists[half:]]
        found = list(_parts(np.diff(l_off[at : to + 1]), left, np.diff(r_off[at : to + 1]), right, kinds, strips))
        if found:
            strip, sizes, parts = zip(*found)
            yield pa.record_batch({"strip": pa.array(strip, pa.int32()), "sizes": pa.array(sizes, pa.list_(pa.int32())), "parts": pa.array(parts, pa.list_(pa.binary()))})
        at = to


def _first(left, score, k):
    """Places of the ``k`` best of each run of left ids by score to nine digits, and of all that tie with the last of them."""
    digits, known = np.rint(score * 1e9), score > -np.inf  # as np.round has it
    lowest, highest = digits[known].min(initial=0.0), digits[known].max(initial=0.0)
    start = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
    if not (highest - lowest + 2) * len(start) < 2.0**53:  # nor if any is not a number
        return np.arange(len(left))
    size = np.diff(start, append=len(left))
    run = np.repeat(np.arange(len(start)), size)
    key = np.where(known, highest - digits, highest - lowest + 1).astype(np.int64) + run * int(highest - lowest + 2)
    last = np.sort(key)[start + np.minimum(k, size) - 1]
    return np.flatnonzero(key <= last[run])


def _strip_of(ids, strips):
    return ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(strips)


def _parts(l_n, left, r_n, right, kinds, strips):
    l_row, r_row = np.repeat(np.arange(len(l_n)), l_n), np.repeat(np.arange(len(r_n)), r_n)
    strip = _strip_of(left[0], strips)
    order = np.lexsort((left[0], l_row, strip))
    left, l_row, strip = [a[order] for a in left], l_row[order], strip[order]
    order = np.lexsort((right[0], r_row))
    right = [a[order] for a in right]
    # a group is a row's left cells of one strip, with the row's right cells above the group's least id
    first = np.flatnonzero((np.diff(l_row, prepend=-1) != 0) | (np.diff(strip, prepend=strip[:1]) != 0))
    last, row = np.append(first[1:], len(l_row)), l_row[first]
    end = np.cumsum(r_n)[row]
    begin = end - r_n[row]
    ids, place = np.unique(np.concatenate([left[0][first], right[0]]), return_inverse=True)
    begin = np.searchsorted(r_row * len(ids) + place[len(first) :], row * len(ids) + place[: len(first)], side="right")
    some = end > begin
    first, last, begin, end, row, strip = first[some], last[some], begin[some], end[some], row[some], strip[first[some]]
    bounds = np.flatnonzero(np.diff(strip, prepend=strip[:1] + np.uint64(1)))
    for g, h in zip(bounds, np.append(bounds[1:], len(strip))):
        l_n, r_n = last[g:h] - first[g:h], end[g:h] - begin[g:h]
        l_at, r_at = _spans(first[g:h], l_n), _spans(begin[g:h], r_n)
        arrays = [l_n, r_n, *[a[l_at] for a in left], *[a[r_at] for a in right]]
        yield int(strip[g]), [h - g, len(l_at), len(r_at)], [_squeezed(a, kind) for a, (_, kind) in zip(arrays, kinds)]


def _stored(batches, tasks, shared):
    """Rows ``(dim, own, left cells, right cells)`` joined until they have enough cells."""
    held, cells = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        dims, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        (l_off, l_ids), (_, l_vals), (r_off, r_ids), (_, r_vals) = (_Strip._lists(batch, c) for c in range(2, 6))
        at = 0
        while at < len(dims):
            done = int(l_off[at]) + int(r_off[at])
            to = max(at + 1, int(np.searchsorted(l_off[1:].astype(np.int64) + r_off[1:], done + STORED - cells, side="right")))
            l, r = slice(l_off[at], l_off[to]), slice(r_off[at], r_off[to])
            held.append((dims[at:to], own[at:to], np.diff(l_off[at : to + 1]), l_ids[l], l_vals[l], np.diff(r_off[at : to + 1]), r_ids[r], r_vals[r]))
            cells += int(l_off[to]) + int(r_off[to]) - done
            if cells >= STORED:
                yield _stored_row(*(np.concatenate(c) for c in zip(*held)), tasks, shared)
                held, cells = [], 0
            at = to
    if held:
        yield _stored_row(*(np.concatenate(c) for c in zip(*held)), tasks, shared)


def _stored_row(dims, own, l_n, l_ids, l_vals, r_n, r_ids, r_vals, tasks, shared):
    """Sizes and arrays of the rows' right cells, and per task the groups and cells of each of its strips, and their arrays."""
    order = np.lexsort((r_ids, np.repeat(np.arange(len(r_n)), r_n)))
    others = [_squeezed(a, kind) for a, kind in zip((dims, own, r_n, r_ids[order], r_vals[order]), RIGHT)]
    strip, row = _strip_of(l_ids, tasks * shared).astype(np.int64), np.repeat(np.arange(len(l_n)), l_n)
    order = np.lexsort((l_ids, row, strip))
    strip, row, l_ids, l_vals = strip[order], row[order], l_ids[order], l_vals[order]
    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(strip, prepend=-1) != 0))
    n = np.diff(first, append=len(row))
    ends = np.arange(tasks * shared + 1)
    g_at, c_at = np.searchsorted(strip[first], ends), np.searchsorted(strip, ends)
    groups, parts = [], []
    for t in range(0, tasks * shared, shared):
        some = slice(t, t + shared + 1)
        g, c = slice(g_at[t], g_at[t + shared]), slice(c_at[t], c_at[t + shared])
        groups.append(np.r_[np.diff(g_at[some]), np.diff(c_at[some])].tolist())
        parts.append([_squeezed(a, kind) for a, kind in zip((row[first[g]], n[g], l_ids[c], l_vals[c]), LEFT)] if c.stop > c.start else [])
    columns = {"sizes": [[len(dims), len(r_ids)]], "others": [others], "groups": [groups], "parts": [parts]}
    kinds = (pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.binary())))
    return pa.record_batch([pa.array(c, kind) for c, kind in zip(columns.values(), kinds)], names=list(columns))


def _meet(held, batch, i):
    """A stored row's left cells of the strips ``held`` meet the right cells of their rows."""
    sizes, others, groups, parts = (batch.column(c)[i] for c in range(4))
    if not len(parts):
        return
    groups = groups.as_py()
    g_n, c_n = groups[: len(held)], groups[len(held) :]
    rows, n, ids, vals = (_restored(part.as_buffer(), kind, size) for part, kind, size in zip(parts, LEFT, (sum(g_n), sum(g_n), sum(c_n), sum(c_n))))
    of_rows, of_cells = sizes.as_py()
    dims, own, r_n, r_ids, r_vals = (_restored(part.as_buffer(), kind, size) for part, kind, size in zip(others, RIGHT, (of_rows, of_rows, of_rows, of_cells, of_cells)))
    r_at = np.cumsum(r_n, dtype=np.int64) - r_n
    g = c = 0
    for strip, groups, cells in zip(held, g_n, c_n):
        if cells:
            some, l = slice(g, g + groups), slice(c, c + cells)
            row = rows[some]
            at = _spans(r_at[row], r_n[row].astype(np.int64))
            strip.add(dims[row], own[row] > 0, n[some], ids[l], vals[l], r_n[row], r_ids[at], r_vals[at])
        g, c = g + groups, c + cells


def _spans(begin, n):
    """The places ``begin`` to ``begin + n`` of all spans."""
    return np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)


def _squeezed(values, kind):
    """Steps of ids and plain other values, byte by byte of all."""
    values = np.ascontiguousarray(values, kind)
    if kind == "i8":
        values = np.diff(values, prepend=np.int64(0))
    return pa.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), codec="zstd", asbytes=True)


def _restored(part, kind, n):
    if not n:
        return np.zeros(0, kind)
    wide = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(part, n * wide, codec="zstd"), np.uint8)
    values = np.ascontiguousarray(raw.reshape(wide, n).T).view(kind).ravel()
    return np.cumsum(values, dtype=np.int64) if kind == "i8" else values


class _Strip:
    """Running sums per (left id, right id) of one strip."""

    def __init__(self, n: int, weight: str = "", direct: bool = False):
        self.n, self.weight, self.direct = n, weight, direct
        self.codes = [np.zeros(0, np.int16), np.zeros(0, np.int16)]
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.keys, self.values, self.held, self.least = [], [], 0, PRODUCTS
        self.taken = []

    @staticmethod
    def _index(table: dict[int, int], ids: np.ndarray) -> np.ndarray:
        values, inverse = np.unique(ids, return_inverse=True)
        places = np.array([table.setdefault(v, len(table)) for v in values.tolist()], dtype=np.int64)
        return places[inverse]

    def add(self, dims, own, l_n, l_ids, l_vals, r_n, r_ids, r_vals):
        """Rows with their left and right cells; the dimensions of ``own`` rows are left out as right ids."""
        li = self._index(self.left, l_ids)
        if own.any():
            if self.direct:
                own, others = own & (dims >= 0) & (dims < 1 << _LOW), dims
            else:
                others = self._index(self.right, dims)
            left_out = np.repeat(own, l_n)
            self.taken.append((li[left_out] << _LOW) | np.repeat(others[own], l_n[own]))
        if len(r_ids):
            self._multiply(l_n, li, l_vals, r_n, r_ids if self.direct else self._index(self.right, r_ids), r_vals)

    @staticmethod
    def _lists(batch, column):
        array = batch.column(column)
        off = array.offsets.to_numpy()
        values = array.values.to_numpy(zero_copy_only=False)
        return off - off[0], values[off[0] : off[-1]]

    def add_packed(self, batch):
        """Parts of :func:`_dealt`, joined until their right cells fill part of a buffer."""
        held, cells = [], 0
        for sizes, parts in zip(batch.column(0), batch.column(1)):
            sizes = sizes.as_py()
            held.append([_restored(part.as_buffer(), kind, sizes[of]) for part, (of, kind) in zip(parts, PAIRS)])
            cells += sizes[2]
            if cells >= PRODUCTS // 4:
                self._unpacked(held)
                held, cells = [], 0
        if held:
            self._unpacked(held)

    def _unpacked(self, held):
        l_n, r_n, l_ids, l_vals, l_codes, r_ids, r_vals, r_codes = (np.concatenate(a) for a in zip(*held))
        li, ri = self._index(self.left, l_ids), self._index(self.right, r_ids)
        for side, table, places, codes in ((0, self.left, li, l_codes), (1, self.right, ri, r_codes)):
            noted = np.zeros(len(table), np.int16)
            noted[: len(self.codes[side])] = self.codes[side]
            noted[places] = codes
            self.codes[side] = noted
        self._multiply(l_n, li, l_vals, r_n, ri, r_vals, (l_ids, r_ids))

    def dots(self):
        """Left ids, right ids, their products' sums and the least their lengths' product can be."""
        left, right, (dot,), li, ri = self.sums(places=True)
        least = np.exp2((self.codes[0][li].astype(float) + self.codes[1][ri]) / STEPS)
        return left, right, dot, least

    def _multiply(self, l_n, li, l_vals, r_n, ri, r_vals, ids=None):
        """All products of each row's cells; with ``ids`` of both sides those of greater right ids."""
        r_off = np.cumsum(r_n, dtype=np.int64) - r_n
        row = np.repeat(np.arange(len(l_n)), l_n)
        ends = np.cumsum(r_n[row])
        at = 0
        while at < len(row):  # left cells whose products fill a buffer
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + PRODUCTS, side="right")))
            partners = r_n[row[at:to]]
            first = np.cumsum(partners) - partners
            pos = np.arange(int(partners.sum())) + np.repeat(r_off[row[at:to]] - first, partners)
            key = np.repeat(li[at:to] << _LOW, partners) | ri[pos]
            lv, rv = np.repeat(l_vals[at:to], partners), r_vals[pos]
            if ids is not None:
                later = np.repeat(ids[0][at:to], partners) < ids[1][pos]
                key, lv, rv = key[later], lv[later], rv[later]
            value = lv * rv
            parts = [value]
            if self.n > 1:
                known = ~np.isnan(value)
                weights = lv if self.weight == "left" else rv
                parts = [np.where(known, value, 0.0), np.abs(weights), known.astype(float), np.ones(len(value))]
            self.keys.append(key)
            self.values.append(parts)
            self.held += len(key)
            if self.held >= self.least:
                self._compact()
                self.least = self.held + PRODUCTS
            at = to

    def _compact(self):
        keys, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
        sums = [np.bincount(inverse, np.concatenate([v[i] for v in self.values]), len(keys)) for i in range(self.n)]
        self.keys, self.values, self.held = [keys], [sums], len(keys)

    def sums(self, places=False):
        """Left ids, right ids and their sums, without the excluded pairs, and the places of the ids if asked for."""
        if not self.keys:
            none = np.zeros(0, np.int64)
            return none, none, [np.zeros(0) for _ in range(self.n)], *[none, none][: 2 * places]
        self._compact()
        keys, sums = self.keys[0], self.values[0]
        if self.taken:
            taken = np.concatenate(self.taken)
            at = np.searchsorted(keys, taken)
            keep = np.ones(len(keys), bool)
            keep[at[keys[np.minimum(at, len(keys) - 1)] == taken]] = False
            keys, sums = keys[keep], [s[keep] for s in sums]
        left, right = np.array(list(self.left), np.int64), np.array(list(self.right), np.int64)
        li, ri = keys >> _LOW, keys & ((1 << _LOW) - 1)
        return left[li], ri if self.direct else right[ri], sums, *[li, ri][: 2 * places]
