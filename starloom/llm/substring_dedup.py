"""Substring dedup by de Bruijn compaction of repeated token k-mers.

The graph is sampled: of the k-mers in each window of ``WINDOW`` words the one
with the least hash is a node, so equal windows choose equal nodes. An edge is
the exact run of words from one node to the next; the begin and the end of a
document are nodes of their own, with the words up to the next node as edge.

1. Nodes are counted; those found once are dropped, as no window that chose
   them can be repeated.
2. Edges between the others are counted. Where a node, the edge out of it and
   the next node have the same count, every one of them continues in the same
   way: the path does not branch there, and runs of such links are compacted.
   A window inside a compacted path of count two or more is repeated, and so is
   each of its copies, whose surroundings are the same.
3. Windows whose node is repeated but which reach over a branch are held
   against each other by their own hash. Only those found once come back, with
   their place: they stay, all others go.

Words are 64-bit hashes, windows 96 bits of two independent ones. Null, empty
and short texts have no windows. Repeated rows are copies of each other; a row
without id is known by its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm import words as W
from starloom.llm.tables import Scratch, keyed, matching, rebatched

WINDOW, K = 35, 8
_BASE, _SECOND = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


@dataclass
class Nodes:
    """Nodes of a chunk in order; each row with windows has one for its begin and one for its end.

    ``at`` is the first word of a node: one before the row's for its begin, one after its last for its end.
    """

    row: np.ndarray
    at: np.ndarray
    key: np.ndarray
    edge: np.ndarray
    window: np.ndarray
    chosen: np.ndarray


def nodes_of(chunk: W.Chunk, hashes: np.ndarray, window: int, k: int) -> Nodes:
    """Nodes and edges, and for each window its first word and the number of its node."""
    n = len(hashes)
    none = np.zeros(0, np.int64)
    room = chunk.room()
    windows = np.flatnonzero(room >= window)
    if not len(windows):
        return Nodes(none, none, none.view(np.uint64), none.view(np.uint64), none, none)
    grams = chunk.windows(hashes, k)
    least = np.lib.stride_tricks.sliding_window_view(grams, window - k + 1).argmin(axis=1)
    chosen = windows + least[windows]
    at = np.unique(chosen)
    row = np.searchsorted(chunk.bounds, at, side="right") - 1
    rows = np.unique(row)
    up, down = W.powers(_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    run = lambda a, b: W.mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
    first = np.searchsorted(row, rows, side="left")
    last = np.searchsorted(row, rows, side="right") - 1
    begin = W.mix(run(chunk.bounds[rows], at[first] + k) ^ _START)
    end = W.mix(run(at[last], chunk.bounds[rows + 1]) ^ _END)
    edge = run(at, np.append(at[1:], 0) + k)
    edge[last] = end
    all_row = np.concatenate([row, rows, rows])
    all_at = np.concatenate([at, chunk.bounds[rows] - 1, chunk.bounds[rows + 1]])
    order = np.lexsort((all_at, all_row))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Nodes(all_row[order], all_at[order], np.concatenate([grams[at], begin, end])[order],
                 np.concatenate([edge, begin, end])[order], windows, place[np.searchsorted(at, chosen)])


def _graph(docs: DataFrame, window: int, k: int) -> DataFrame:
    """Nodes of all documents: ``doc_id``, ``at`` (word number), ``node``, ``edge``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches):
            ids = batch["doc_id"].to_numpy()
            for chunk in W.chunks(batch["text"], W.space_separated()):
                g = nodes_of(chunk, chunk.hashes(), window, k)
                yield pa.record_batch({
                    "doc_id": pa.array(ids[chunk.first + g.row]), "at": pa.array((g.at - chunk.bounds[g.row]).astype(np.int32)),
                    "node": pa.array(g.key.view(np.int64)), "edge": pa.array(g.edge.view(np.int64))})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, at int, node bigint, edge bigint")


MARKS = "array<struct<at:int,n:bigint,e:bigint>>"


def _marks(graph: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document its repeated nodes with their count and the count of the edge out of them."""
    nodes = graph.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    repeated = scratch.store(graph.join(nodes, "node").select("doc_id", "at", "edge", "n"), "repeated")
    edges = repeated.groupBy("edge").agg(F.count("*").alias("e")).where("e > 1")
    counted = repeated.join(edges, "edge", "left").select(
        "doc_id", F.struct("at", "n", F.coalesce("e", F.lit(1)).alias("e")).alias("mark"))
    marks = scratch.store(counted.groupBy("doc_id").agg(F.sort_array(F.collect_set("mark")).alias("marks")), "marks")
    scratch.drop(repeated)
    return marks


def _decided(chunk: W.Chunk, hashes: np.ndarray, marks: pa.Array, window: int, k: int) -> tuple[Nodes, np.ndarray, np.ndarray]:
    """Of the windows of a chunk, which are repeated for certain, and which are to be looked up."""
    g = nodes_of(chunk, hashes, window, k)
    if not len(g.window):
        return g, np.zeros(0, bool), np.zeros(0, bool)
    flat = marks.flatten()
    size = np.diff(marks.offsets.to_numpy())
    row = np.repeat(np.arange(len(marks)), size)
    place = flat.field("at").to_numpy() + chunk.bounds[row]
    # begin and end of neighbouring rows may share a number, so rows are told apart by a stride
    stride = len(hashes) + 2
    here = np.searchsorted(g.row * stride + g.at + 1, row * stride + place + 1)
    n, e = np.ones(len(g.at), np.int64), np.ones(len(g.at), np.int64)
    n[here], e[here] = flat.field("n").to_numpy(), flat.field("e").to_numpy()
    same_row = g.row[:-1] == g.row[1:]
    linked = same_row & (n[:-1] == e[:-1]) & (n[:-1] == n[1:]) & (n[:-1] > 1)
    broken = np.concatenate([[0], np.cumsum(~linked)])
    of = g.row[g.chosen] * stride
    left = np.searchsorted(g.row * stride + g.at + 1, of + g.window + 1, side="right") - 1
    right = np.searchsorted(g.row * stride + g.at + 1, of + g.window + window - k + 1, side="left")
    sure = broken[right] == broken[left]
    return g, sure, (n[g.chosen] > 1) & ~sure


def _open_windows(docs: DataFrame, window: int, k: int) -> DataFrame:
    """Hashes and places of the windows that counts alone do not decide."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches):
            ids, marks = batch["doc_id"].to_numpy(), batch["marks"]
            for chunk in W.chunks(batch["text"], W.space_separated()):
                hashes = chunk.hashes()
                g, _, look = _decided(chunk, hashes, _rows(marks, chunk), window, k)
                at = g.window[look]
                row = g.row[g.chosen[look]]
                yield pa.record_batch({
                    "h1": pa.array(chunk.windows(hashes, window, _BASE)[at].view(np.int64)),
                    "h2": pa.array((chunk.windows(hashes, window, _SECOND)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    "doc_id": pa.array(ids[chunk.first + row]), "at": pa.array((at - chunk.bounds[row]).astype(np.int32))})

    return docs.select("doc_id", "text", "marks").mapInArrow(run, "h1 bigint, h2 int, doc_id bigint, at int")


def _rows(column: pa.Array, chunk: W.Chunk) -> pa.Array:
    """A chunk's part of a list column, with offsets from 0."""
    return column.take(pa.array(np.arange(chunk.first, chunk.first + chunk.rows)))


def covered(chunk: W.Chunk, starts: np.ndarray, window: int) -> np.ndarray:
    """Words of a chunk inside any of the windows that begin at ``starts``."""
    edges = np.zeros(len(chunk.starts) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


KEPT = "id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept_text string"


def _cut(docs: DataFrame, window: int, k: int) -> DataFrame:
    """Repeated spans and the text without them, from ``marks`` and the windows that are ``single``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches):
            n_words, spans, texts = [], [], []
            for chunk in W.chunks(batch["text"], W.space_separated()):
                gone = np.zeros(len(chunk.starts), bool)
                if "marks" in batch.schema.names:
                    g, sure, look = _decided(chunk, chunk.hashes(), _rows(batch["marks"], chunk), window, k)
                    single = _rows(batch["single"], chunk)
                    row = np.repeat(np.arange(chunk.rows), np.diff(single.offsets.to_numpy()))
                    unique = chunk.bounds[row] + single.flatten().to_numpy()
                    gone = covered(chunk, g.window[sure | (look & ~np.isin(g.window, unique))], window)
                for row in range(chunk.rows):
                    a, b = chunk.bounds[row], chunk.bounds[row + 1]
                    n_words.append(b - a)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
                    spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
                    raw = chunk.buf[chunk.text_at[row]:chunk.text_at[row + 1]].tobytes().split()
                    texts.append(b" ".join(w for w, x in zip(raw, gone[a:b]) if not x) if len(edges) else b" ".join(raw))
            yield pa.record_batch({
                "id": batch["id"], "n_words": pa.array(np.array(n_words, np.int64)),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string())})

    return docs.mapInArrow(run, KEPT)


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = K, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, repeated ``spans`` (words), ``n_removed`` and the ``kept_text``.

    A span is a union of windows of ``window`` words whose words also begin
    elsewhere; all of its copies go, the first one too.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_column, text_column)
    scratch = Scratch(spark, "substrings")
    graph = scratch.store(_graph(rows, window, k), "graph")
    marks = _marks(graph, scratch)
    scratch.drop(graph)
    touched = marks.count()
    near = matching(rows, marks, touched).join(marks, "doc_id")
    opened = _open_windows(near, window, k).groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("at").alias("at")).where("n = 1")
    single = scratch.store(opened.groupBy("doc_id").agg(F.collect_list("at").alias("single")), "single")
    near = near.join(single, "doc_id", "left").withColumn("single", F.coalesce("single", F.array().cast("array<int>")))
    far = matching(rows, marks, touched, "left_anti")
    cut = _cut(near.select("id", "text", "marks", "single"), window, k).unionAll(_cut(far.select("id", "text"), window, k))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(F.col("id").alias("doc_id"), "n_words", "spans", removed.alias("n_removed"), "kept_text")
