"""Exact similarity search over sparse vectors by block products.

Vectors are long tables ``(id, dim, val)``. Ids are spread over blocks; the
cells of one block and dimension are packed into one row (at most a block's
ids), left and right blocks meet on the dimension, and every task multiplies
one left block by one right block. Dot products are summed inside the task, so
only results are emitted: the top of each block pair, never the pairs of ids
that share a dimension.

A block's size bounds the memory of a task, whatever the length of its
vectors. Ids with more than ``hot_rows`` cells get blocks of their own whose
work is cut into slices of the dimensions; the partial sums of those few rows
are added up by a grouped sum.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.scores import top_n
from starloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_IDS = 4096
HOT_ROWS = 5_000_000
PAIR_CHUNK = 4_000_000
DENSE_RATIO = 50
DENSE_ROWS = 512
#: Cells of a block's product that are copied at once.
STRIP_CELLS = 1 << 20

MAX_TASKS = 20_000

# kinds of task rows; requests of the mirrored direction swap left and right
CELLS, EXCLUDED, REQUESTS, MIRRORED = 0, 1, 2, 3


@dataclass
class Layout:
    """How the ids of one side are spread over blocks."""

    blocks: int
    hot: DataFrame | None = None
    hot_blocks: int = 0
    slices: int = 1

    @property
    def total(self) -> int:
        return self.blocks + self.hot_blocks

    def assign(self, df: DataFrame, column: str, block: str) -> DataFrame:
        plain = F.pmod(F.xxhash64(column), F.lit(self.blocks)).cast("int")
        if self.hot is None:
            return df.withColumn(block, plain)
        hot = self.hot.select(F.col("id").alias("_hot_id"))
        own = (F.lit(self.blocks) + F.pmod(F.xxhash64(column), F.lit(self.hot_blocks))).cast("int")
        joined = df.join(hot, F.col(column) == F.col("_hot_id"), "left")
        return joined.withColumn(block, F.when(F.col("_hot_id").isNull(), plain).otherwise(own)).drop("_hot_id")


def plan_layout(vectors: DataFrame, hot_rows: int = HOT_ROWS, block_ids: int = BLOCK_IDS) -> Layout:
    """Counts the ids and their longest vector (three numbers reach the driver)."""
    sizes = vectors.groupBy("id").agg(F.count("*").alias("n"))
    ids, longest, hot = sizes.agg(
        F.count("*"), F.coalesce(F.max("n"), F.lit(0)), F.count_if(F.col("n") > hot_rows)
    ).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    spread = min(math.ceil(math.sqrt(2 * cores)), math.ceil(ids / 128))
    blocks = max(1, spread, math.ceil(ids / block_ids))
    if not hot:
        return Layout(blocks)
    return Layout(
        blocks,
        sizes.where(F.col("n") > hot_rows).select("id"),
        math.ceil(hot / block_ids),
        math.ceil(longest / hot_rows),
    )


def unit(vectors: DataFrame) -> DataFrame:
    """Scales every vector to length one; zero vectors disappear.

    The lengths are stored, so that the join can split a very long vector.
    """
    norms = materialize(vectors.groupBy("id").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("norm")), "norms")
    return vectors.join(norms.where("norm > 0"), "id").select("id", "dim", (F.col("val") / F.col("norm")).alias("val"))


def _pack(df: DataFrame, layout: Layout, keys: list[str], block: str, side: str) -> DataFrame:
    cells = F.collect_list(F.struct("id", "val"))
    packed = layout.assign(df, "id", block).groupBy(block, *keys).agg(cells.alias("cells"))
    return packed.select(
        block, *keys, F.col("cells.id").alias(f"{side}_ids"), F.col("cells.val").alias(f"{side}_vals")
    )


def _slice(left: Layout, right: Layout, key: Column) -> Column:
    """Slice of a dimension: 0 unless one of the two blocks is hot."""
    hot = _is_hot(left, right)
    n = max(left.slices, right.slices)
    return F.when(hot, F.pmod(F.xxhash64(key), F.lit(n))).otherwise(0).cast("int")


def _is_hot(left: Layout, right: Layout) -> Column:
    return (F.col("p") >= left.blocks) | (F.col("q") >= right.blocks)


def _cell_rows(left: DataFrame, right: DataFrame, ll: Layout, rl: Layout, mirror: bool) -> DataFrame:
    lhs = _pack(left, ll, ["dim"], "p", "l")
    rhs = _pack(right, rl, ["dim"], "q", "r")
    rows = lhs.join(rhs, "dim")
    if mirror:
        rows = rows.where("p <= q")
    rows = rows.withColumn("slice", _slice(ll, rl, F.col("dim"))).withColumn("kind", F.lit(CELLS))
    return rows.select("p", "q", "slice", "kind", "l_ids", "l_vals", "r_ids", "r_vals")


def _present_rows(left: DataFrame, right: DataFrame, ll: Layout, rl: Layout, mirror: bool) -> DataFrame:
    """A dimension that all ids share with the value 0, so that every pair of ids has a score."""
    present = lambda df: df.select("id").distinct().withColumns({"dim": F.lit(0), "val": F.lit(0.0)})
    return _cell_rows(present(left), present(right), ll, rl, mirror)


def _excluded_rows(exclude: DataFrame, ll: Layout, rl: Layout) -> DataFrame:
    pairs = rl.assign(ll.assign(exclude.select("id", "other"), "id", "p"), "other", "q")
    empty = F.array().cast("array<double>")
    return pairs.groupBy("p", "q", "id").agg(F.collect_list("other").alias("r_ids")).select(
        "p", "q", F.lit(0).alias("slice"), F.lit(EXCLUDED).alias("kind"),
        F.array("id").alias("l_ids"), empty.alias("l_vals"), "r_ids", empty.alias("r_vals"),
    )


def _run(rows: DataFrame, kernel, schema: str, ll: Layout, rl: Layout, mirror: bool) -> DataFrame:
    """One partition per block pair and slice, rows in kernel order."""
    p, q = F.col("p"), F.col("q")
    if mirror:
        pair, pairs = q * (q + 1) / 2 + p, ll.total * (ll.total + 1) // 2
    else:
        pair, pairs = p * rl.total + q, ll.total * rl.total
    slices = max(ll.slices, rl.slices)
    place = (pair * slices + F.col("slice")).cast("int")
    tasks = min(pairs * slices, MAX_TASKS)
    placed = rows.repartitionById(tasks, F.pmod(place, F.lit(tasks)))
    return placed.sortWithinPartitions("p", "q", "slice", "kind").mapInArrow(kernel, schema)


def nearest(
    left: DataFrame,
    right: DataFrame | None = None,
    k: int | None = None,
    min_score: float | None = None,
    exclude: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """``(id, other, score[, rank])``: the best right vectors for each left vector.

    Without ``right`` the left vectors are compared with each other and an id
    is never its own neighbour. ``min_score`` (0 if not given) is exclusive.
    ``exclude`` lists ``(id, other)`` pairs to leave out. Ties go to the
    smaller id. Below a ``min_score`` of 0 every pair of ids counts, with a
    score of 0 where the two share no dimension.
    """
    same = right is None
    # without exclusions one product serves both directions of a block pair
    mirror = same and exclude is None
    ll = plan_layout(left, hot_rows, block_ids)
    rl = ll if same else plan_layout(right, hot_rows, block_ids)
    rows = _cell_rows(left, left if same else right, ll, rl, mirror)
    floor = 0.0 if min_score is None else min_score
    if floor < 0:
        rows = rows.unionByName(_present_rows(left, left if same else right, ll, rl, mirror))
    if exclude is not None:
        rows = rows.unionByName(_excluded_rows(exclude, ll, rl))
    l_blocks, r_blocks = ll.blocks, rl.blocks

    def kernel(batches):
        return _top_kernel(batches, same, mirror, k, floor, l_blocks, r_blocks)

    found = _run(rows, kernel, "id bigint, other bigint, score double, partial boolean", ll, rl, mirror)
    if ll.hot is None and rl.hot is None:
        found = found.drop("partial")
    else:
        sums = found.where("partial").groupBy("id", "other").agg(F.sum("score").alias("score"))
        sums = sums.where(F.col("score") > floor)
        if exclude is not None:
            sums = sums.join(exclude.select("id", "other"), ["id", "other"], "left_anti")
        found = found.where("NOT partial").drop("partial").unionByName(sums)
    if k is None:
        return found
    return top_n(found, ["id"], k, F.round("score", 9).desc(), F.col("other").asc())


def best_means(
    left: DataFrame,
    right: DataFrame,
    k: int,
    exclude: DataFrame,
    hot_rows: int = HOT_ROWS,
    block_ids: int = BLOCK_IDS // 2,
) -> DataFrame:
    """``(id, other, score, support, rank)``: the ``k`` largest means of the left values, weighted by the right ones.

    ``score`` is the sum of left times right values over the shared dimensions,
    divided by the sum of the right values there; ``support`` counts them. The
    right values are positive. Three sums are kept in a task, so its blocks are
    smaller; only the best of each block pair leave it. ``exclude`` lists
    ``(id, other)`` pairs to leave out, and ties go to the smaller id.
    """
    ll, rl = plan_layout(left, hot_rows, block_ids), plan_layout(right, hot_rows, block_ids)
    rows = _cell_rows(left, right, ll, rl, False).unionByName(_excluded_rows(exclude, ll, rl))
    l_blocks, r_blocks = ll.blocks, rl.blocks

    def kernel(batches):
        return _mean_kernel(batches, k, l_blocks, r_blocks)

    schema = "id bigint, other bigint, num double, den double, support double, partial boolean"
    found = _run(rows, kernel, schema, ll, rl, False)
    if ll.hot is None and rl.hot is None:
        found = found.drop("partial")
    else:
        sums = found.where("partial").groupBy("id", "other").agg(*[F.sum(c).alias(c) for c in ("num", "den", "support")])
        sums = sums.join(exclude.select("id", "other"), ["id", "other"], "left_anti")
        found = found.where("NOT partial").drop("partial").unionByName(sums)
    means = found.select("id", "other", (F.col("num") / F.col("den")).alias("score"), F.col("support").cast("bigint").alias("support"))
    return top_n(means, ["id"], k, F.round("score", 9).desc(), F.col("other").asc())


def _request_rows(vectors: DataFrame, history: DataFrame, targets: DataFrame, layout: Layout) -> DataFrame:
    """Task rows of the products, followed by what each user asks of a block pair."""
    rows = _cell_rows(vectors, vectors, layout, layout, True)
    wanted = targets.select("user_id", F.col("item_id").alias("id"), F.lit(0.0).alias("val"))
    rated = history.select("user_id", F.col("item_id").alias("id"), F.col("rating").alias("val"))
    lhs = _pack(wanted, layout, ["user_id"], "p", "l")
    rhs = _pack(rated, layout, ["user_id"], "q", "r")
    slices = F.when(_is_hot(layout, layout), F.lit(layout.slices)).otherwise(1)
    requests = lhs.join(rhs, "user_id").select(
        F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"),
        F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"),
        F.when(F.col("p") <= F.col("q"), REQUESTS).otherwise(MIRRORED).alias("kind"),
        # the user id leads the list of wanted ids
        F.concat(F.array("user_id"), "l_ids").alias("l_ids"), "l_vals", "r_ids", "r_vals",
    )
    return rows.unionByName(requests)


def weighted_scores(
    vectors: DataFrame,
    history: DataFrame,
    targets: DataFrame,
    hot_rows: int = HOT_ROWS,
    block_ids: int = BLOCK_IDS,
    positive: bool = False,
) -> DataFrame:
    """``(user_id, item_id, num, den)`` for every target with a similar rated item.

    ``num`` is the sum of similarity times rating and ``den`` the sum of
    absolute similarities over the user's whole ``history(user_id, item_id,
    rating)``, the target itself left out. The similarities exist only inside
    the block tasks. Hot slices need non-negative vectors, as ratings are.
    With ``positive`` only similarities above zero (by more than rounding)
    count; the sign needs the whole product, so no id is sliced then: signed
    vectors have features as dimensions, whose number the vocabulary bounds.
    """
    layout = plan_layout(vectors, sys.maxsize if positive else hot_rows, block_ids)
    rows = _request_rows(vectors, history, targets, layout)
    schema = "user_id bigint, item_id bigint, num double, den double"

    def kernel(batches):
        return _score_kernel(batches, positive)

    parts = _run(rows, kernel, schema, layout, layout, True)
    return parts.groupBy("user_id", "item_id").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))


def supporters(
    vectors: DataFrame,
    history: DataFrame,
    targets: DataFrame,
    m: int,
    min_score: float,
    hot_rows: int = HOT_ROWS,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """``(user_id, item_id, other, score, rank)``: the ``m`` rated items most similar to each target."""
    layout = plan_layout(vectors, hot_rows, block_ids)
    rows = _request_rows(vectors, history, targets, layout)
    plain = layout.blocks

    def kernel(batches):
        return _support_kernel(batches, m, min_score, plain)

    schema = "user_id bigint, item_id bigint, other bigint, score double, partial boolean"
    found = _run(rows, kernel, schema, layout, layout, True)
    if layout.hot is None:
        found = found.drop("partial")
    else:
        sums = found.where("partial").groupBy("user_id", "item_id", "other").agg(F.sum("score").alias("score"))
        found = found.where("NOT partial").drop("partial").unionByName(sums.where(F.col("score") > min_score))
    return top_n(found, ["user_id", "item_id"], m, F.round("score", 9).desc(), F.col("other").asc())


class _Product:
    """Running product of one left block and one right block."""

    def __init__(self):
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.acc = np.zeros((0, 0))
        self.excluded: list[tuple[int, np.ndarray]] = []

    @staticmethod
    def _index(table: dict[int, int], ids: np.ndarray) -> np.ndarray:
        values, inverse = np.unique(ids, return_inverse=True)
        places = np.array([table.setdefault(v, len(table)) for v in values.tolist()], dtype=np.int64)
        return places[inverse]

    def _grow(self):
        rows, cols = self.acc.shape
        if len(self.left) > rows or len(self.right) > cols:
            wider = np.zeros((max(rows, len(self.left) * 5 // 4 + 64), max(cols, len(self.right) * 5 // 4 + 64)))
            wider[:rows, :cols] = self.acc
            self.acc = wider

    def add(self, l_off, l_ids, l_vals, r_off, r_ids, r_vals):
        li, ri = self._index(self.left, l_ids), self._index(self.right, r_ids)
        self._grow()
        l_n, r_n = np.diff(l_off), np.diff(r_off)
        pairs = l_n * r_n
        if pairs.sum() * DENSE_RATIO > len(pairs) * len(self.left) * len(self.right):
            for at in range(0, len(pairs), DENSE_ROWS):
                rows = slice(at, at + DENSE_ROWS)
                a = self._dense(l_off, l_n, li, l_vals, rows, len(self.left))
                b = self._dense(r_off, r_n, ri, r_vals, rows, len(self.right))
                step = max(1, STRIP_CELLS // max(1, b.shape[1]))
                for top in range(0, a.shape[1], step):
                    self.acc[top : min(top + step, a.shape[1]), : b.shape[1]] += a[:, top : top + step].T @ b
            return
        ends = np.cumsum(pairs)
        at = 0
        while at < len(pairs):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + PAIR_CHUNK, side="right")))
            self._sparse(l_off, l_n, li, l_vals, r_off, r_n, ri, r_vals, at, to)
            at = to

    @staticmethod
    def _dense(off, n, index, vals, rows, width):
        count = n[rows]
        cells = slice(off[rows.start], off[rows.start] + count.sum())
        out = np.zeros((len(count), width))
        out[np.repeat(np.arange(len(count)), count), index[cells]] = vals[cells]
        return out

    def _sparse(self, l_off, l_n, li, l_vals, r_off, r_n, ri, r_vals, at, to):
        cells = slice(l_off[at], l_off[to])
        row = np.repeat(np.arange(at, to), l_n[at:to])
        partners = r_n[row]
        total = int(partners.sum())
        first = np.cumsum(partners) - partners
        r_pos = np.arange(total) + np.repeat(r_off[row] - first, partners)
        width = self.acc.shape[1]
        flat = np.repeat(li[cells], partners) * width + ri[r_pos]
        value = np.repeat(l_vals[cells], partners) * r_vals[r_pos]
        if total * 4 > self.acc.size:
            self.acc += np.bincount(flat, value, self.acc.size).reshape(self.acc.shape)
        else:
            np.add.at(self.acc.reshape(-1), flat, value)

    def ids(self):
        return np.array(list(self.left), dtype=np.int64), np.array(list(self.right), dtype=np.int64)

    def scores(self):
        return self.acc[: len(self.left), : len(self.right)]

    def drop_self(self, value: float):
        for key, row in self.left.items():
            col = self.right.get(key)
            if col is not None:
                self.acc[row, col] = value


def _lists(batch, column):
    array = batch.column(column)
    return array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)


def _runs(batches):
    """``(key, kind, columns)`` for each run of rows of one task key and kind."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        p, q, s, kind = (batch.column(i).to_numpy() for i in range(4))
        change = (np.diff(p) != 0) | (np.diff(q) != 0) | (np.diff(s) != 0) | (np.diff(kind) != 0)
        starts = np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))
        lists = [_lists(batch, i) for i in range(4, 8)]
        for a, b in zip(starts[:-1], starts[1:]):
            parts = []
            for off, values in lists:
                parts.append((off[a : b + 1] - off[a], values[off[a] : off[b]]))
            yield (int(p[a]), int(q[a]), int(s[a])), int(kind[a]), parts


def _top_kernel(batches, same, mirror, k, floor, l_blocks, r_blocks):
    key, block = None, None

    def flush():
        if same:
            hot = key[0] >= l_blocks or key[1] >= l_blocks
        else:
            hot = key[0] >= l_blocks or key[1] >= r_blocks
        for left, others in block.excluded:
            row = block.left.get(left)
            cols = [block.right[o] for o in others.tolist() if o in block.right]
            if row is not None and cols:
                block.acc[row, cols] = -np.inf
        if same:
            block.drop_self(-np.inf)
        left, right = block.ids()
        sides = [(left, right, block.scores())]
        if mirror and key[0] != key[1]:
            sides.append((right, left, block.scores().T))
        for side in sides:
            if not side[2].size:
                continue
            yield _partial_sums(*side, floor) if hot else _best(*side, k, floor)

    for run_key, kind, (l, l_vals, r, r_vals) in _runs(batches):
        if run_key != key:
            if block is not None:
                yield from flush()
            key, block = run_key, _Product()
        if kind == CELLS:
            block.add(l[0], l[1], l_vals[1], r[0], r[1], r_vals[1])
        else:
            for i, left in enumerate(l[1].tolist()):
                block.excluded.append((left, r[1][r[0][i] : r[0][i + 1]]))
    if block is not None:
        yield from flush()


def _batch(ids, others, scores, partial):
    flags = np.full(len(ids), partial)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(others), pa.array(scores), pa.array(flags)], ["id", "other", "score", "partial"]
    )


def _partial_sums(left, right, scores, floor):
    """Cells of one slice; zero ones count only where the sum may be zero or less."""
    rows, cols = np.nonzero((scores > -np.inf) & ((scores != 0) | (floor < 0)))
    return _batch(left[rows], right[cols], scores[rows, cols], True)


def _best_cells(right, scores, k, floor):
    """Rows, columns and values above ``floor``; with ``k`` the first k of each row, ties by id."""
    # a strip of rows at a time: what is copied does not follow the block
    step = max(1, STRIP_CELLS // max(1, scores.shape[1]))
    strips = [_best_of_rows(right, scores[at : at + step], k, floor) for at in range(0, max(1, len(scores)), step)]
    first = np.repeat(np.arange(len(strips)) * step, [len(rows) for rows, _, _ in strips])
    rows, cols, values = (np.concatenate(part) for part in zip(*strips))
    return rows + first, cols, values


def _best_of_rows(right, scores, k, floor):
    keep = scores > floor
    if k is not None and keep.sum() > 8 * k * len(scores):
        # many candidates: cut at the k-th best of each row before sorting
        rounded = np.round(scores, 9)
        keep &= rounded >= -np.partition(-rounded, k - 1, axis=1)[:, k - 1 : k]
    rows, cols = np.nonzero(keep)
    values = scores[rows, cols]
    if k is not None and len(rows):
        # rows come in order, so a run of equal rows is one left id
        order = np.lexsort((right[cols], -np.round(values, 9), rows))
        rows, cols, values = rows[order], cols[order], values[order]
        best = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
        rows, cols, values = rows[best], cols[best], values[best]
    return rows, cols, values


def _best(left, right, scores, k, floor):
    rows, cols, values = _best_cells(right, scores, k, floor)
    return _batch(left[rows], right[cols], values, False)


def _mean_kernel(batches, k, l_blocks, r_blocks):
    key, sums = None, None
    excluded: list[tuple[int, np.ndarray]] = []

    def flush():
        num, den, support = (one.scores() for one in sums)
        if not num.size:
            return
        left, right = sums[0].ids()
        hot = key[0] >= l_blocks or key[1] >= r_blocks
        if hot:
            rows, cols = np.nonzero(support)
        else:
            means = np.full(num.shape, -np.inf)
            np.divide(num, den, out=means, where=support > 0)
            for one, others in excluded:
                row = sums[0].left.get(one)
                taken = [sums[0].right[o] for o in others.tolist() if o in sums[0].right]
                if row is not None and taken:
                    means[row, taken] = -np.inf
            rows, cols, _ = _best_cells(right, means, k, -np.inf)
        values = [pa.array(np.ascontiguousarray(one[rows, cols])) for one in (num, den, support)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(left[rows]), pa.array(right[cols]), *values, pa.array(np.full(len(rows), hot))],
            ["id", "other", "num", "den", "support", "partial"])

    for run_key, kind, (l, l_vals, r, r_vals) in _runs(batches):
        if run_key != key:
            if key is not None:
                yield from flush()
            key, sums, excluded = run_key, [_Product() for _ in range(3)], []
        if kind == CELLS:
            one, weight = np.ones(len(l[1])), np.ones(len(r[1]))
            for product, (a, b) in zip(sums, ((l_vals[1], r_vals[1]), (one, r_vals[1]), (one, weight))):
                product.add(l[0], l[1], a, r[0], r[1], b)
        else:
            excluded.extend((i, r[1][r[0][at] : r[0][at + 1]]) for at, i in enumerate(l[1].tolist()))
    if key is not None:
        yield from flush()


def _asked(batches):
    """``(key, user, targets, rated ids, ratings, similarities)`` per request row."""
    key, block, ready = None, None, False
    for run_key, kind, (l, l_vals, r, r_vals) in _runs(batches):
        if run_key != key:
            key, block, ready = run_key, _Product(), False
        if kind == CELLS:
            block.add(l[0], l[1], l_vals[1], r[0], r[1], r_vals[1])
            continue
        if not ready:
            block.drop_self(0.0)
            ready = True
        mine, theirs, scores = block.left, block.right, block.acc
        if kind == MIRRORED:
            mine, theirs, scores = theirs, mine, scores.T
        for i in range(len(l[0]) - 1):
            user, *asked = l[1][l[0][i] : l[0][i + 1]].tolist()
            targets = [t for t in asked if t in mine]
            span = slice(r[0][i], r[0][i + 1])
            known = [(j, theirs[j], v) for j, v in zip(r[1][span].tolist(), r_vals[1][span].tolist()) if j in theirs]
            if targets and known:
                rated, cols, values = zip(*known)
                sims = scores[np.ix_([mine[t] for t in targets], cols)]
                yield key, user, targets, np.array(rated), np.array(values), sims


def _chunks(rows, names, size=50_000):
    """Record batches of at most about ``size`` result rows."""
    out = []
    for part in rows:
        out.extend(part)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)


def _score_kernel(batches, positive=False):
    def rows():
        for _, user, targets, _, values, sims in _asked(batches):
            if positive:
                sims = np.where(sims > 1e-9, sims, 0.0)
            num, den = sims @ values, np.abs(sims).sum(axis=1)
            yield [(user, t, n, d) for t, n, d in zip(targets, num.tolist(), den.tolist()) if d > 0]

    yield from _chunks(rows(), ["user_id", "item_id", "num", "den"])


def _support_kernel(batches, m, min_score, blocks):
    def rows():
        for key, user, targets, rated, _, sims in _asked(batches):
            hot = key[0] >= blocks or key[1] >= blocks
            for target, row in zip(targets, sims):
                keep = np.flatnonzero((row != 0) & (rated != target) if hot else (row > min_score) & (rated != target))
                if not hot:
                    keep = keep[np.lexsort((rated[keep], -np.round(row[keep], 9)))[:m]]
                yield [(user, target, int(rated[j]), float(row[j]), hot) for j in keep.tolist()]

    yield from _chunks(rows(), ["user_id", "item_id", "other", "score", "partial"])
