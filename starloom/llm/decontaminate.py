"""Benchmark decontamination by a prefix-filtered join of item windows.

Windows of item words are sets that a document must contain whole, so the
necessary prefix of each is its rarest word alone; rarity is counted over the
whole corpus. A document word that equals a prefix word proposes a window at
one alignment (the positional bound); windows that would leave the document are
dropped (the length bound); window hashes, then the words themselves, decide.

The items are a query set held against all documents in blocks of bounded size.
Null texts have no words; rows with equal ids are judged each on its own; an
item without an id hits words but is in no list of items. Very long texts are
searched whole. Other columns are ignored, or carried along by
:func:`without_contaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import words as W
from starloom.llm.tables import id_text, rebatched, received, send, stored

#: Characters of items in a block; an index takes about 40 bytes a character and is sent to every worker.
BLOCK_CHARS = 1_000_000
_BASE = 0xD6E8FEB86659FD93
_HITS = "array<struct<start:bigint,end:bigint>>"


@dataclass
class Index:
    """Windows of a block: sorted prefix words, and for each the windows it proposes."""

    keys: np.ndarray
    key_at: np.ndarray
    entry_window: np.ndarray
    entry_offset: np.ndarray
    length: np.ndarray
    window_hash: np.ndarray
    text: list[bytes]
    items: list[list[str]]


def item_windows(items: list[tuple], size: int) -> dict[tuple, set[str]]:
    """Windows (tuples of words) and the items they come from."""
    found: dict[tuple, set[str]] = {}
    lower, word = W.lower_ascii(), W.alphanumeric()
    for key, text in items:
        for chunk in W.chunks(pa.array([text], pa.string()), word, lower):
            words = [chunk.word(i) for i in range(len(chunk.starts))]
            for i in range(max(1, len(words) - size + 1) if words else 0):
                found.setdefault(tuple(words[i:i + size]), set()).update([] if key is None else [str(key)])
    return found


def word_hashes(words: list[bytes]) -> np.ndarray:
    chunk = next(W.chunks(pa.array([b" ".join(words).decode()], pa.string()), W.alphanumeric(), limit=1 << 62))
    return chunk.hashes()


def build(windows: dict[tuple, set[str]], frequency: dict[int, int]) -> Index:
    vocabulary = sorted({w for window in windows for w in window})
    hash_of = dict(zip(vocabulary, word_hashes(vocabulary).tolist())) if vocabulary else {}
    up, _ = W.powers(_BASE, 1 + max((len(w) for w in windows), default=1))
    entries, texts, items, hashes, lengths = [], [], [], [], []
    for number, (window, keys) in enumerate(sorted(windows.items())):
        values = np.array([hash_of[w] for w in window], np.uint64)
        rarest = min(range(len(window)), key=lambda i: (frequency.get(hash_of[window[i]], 0), hash_of[window[i]], i))
        entries.append((hash_of[window[rarest]], number, rarest))
        hashes.append(int(W.mix((values * up[:len(values)]).sum(keepdims=True))[0]))
        texts.append(b" ".join(window))
        items.append(sorted(keys))
        lengths.append(len(window))
    entries.sort()
    of_key = np.array([e[0] for e in entries], np.uint64)
    keys, at = np.unique(of_key, return_index=True)
    return Index(keys, np.append(at, len(entries)), np.array([e[1] for e in entries], np.int64),
                 np.array([e[2] for e in entries], np.int64), np.array(lengths, np.int64), np.array(hashes, np.uint64), texts, items)


def located(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``values`` that occur in the sorted ``keys``, and where."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    here = np.flatnonzero(keys[at] == values)
    return here, at[here]


def occurrences(chunk: W.Chunk, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """First words and numbers of the windows that occur in a chunk."""
    hashes = chunk.hashes()
    here, key = located(index.keys, hashes)
    fan = index.key_at[key + 1] - index.key_at[key]
    entry = np.repeat(index.key_at[key] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
    window = index.entry_window[entry]
    position = np.repeat(here, fan)
    start = position - index.entry_offset[entry]
    row = np.searchsorted(chunk.bounds, position, side="right") - 1
    fits = (start >= chunk.bounds[row]) & (start + index.length[window] <= chunk.bounds[row + 1])
    start, window = start[fits], window[fits]
    up, down = W.powers(_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    same = W.mix((sums[start + index.length[window]] - sums[start]) * down[start]) == index.window_hash[window]
    start, window = start[same], window[same]
    exact = [b" ".join(chunk.word(j) for j in range(s, s + index.length[w])) == index.text[w] for s, w in zip(start, window)]
    exact = np.array(exact, bool)
    return start[exact], window[exact]


def ranges(covered: np.ndarray) -> list[dict]:
    edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))]


def _frequencies(docs: DataFrame, vocabulary: np.ndarray, spark: SparkSession) -> dict[int, int]:
    """Occurrences in all documents of the words of a block of items."""
    held = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lower, word = held.value, W.lower_ascii(), W.alphanumeric()
        sums = np.zeros(len(keys), np.int64)
        for batch in rebatched(batches):
            for chunk in W.chunks(batch["text"], word, lower):
                sums += np.bincount(located(keys, chunk.hashes())[1], minlength=len(keys))
        some = np.flatnonzero(sums)
        yield pa.record_batch({"word": pa.array(keys[some].view(np.int64)), "n": pa.array(sums[some])})

    rows = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(rows["word"].to_numpy().view(np.uint64).tolist(), rows["n"].to_pylist()))


def _scan(docs: DataFrame, index: Index, key: str, spark: SparkSession) -> DataFrame:
    held = send(spark, index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, lower, word = received(held), W.lower_ascii(), W.alphanumeric()
        for batch in rebatched(batches):
            n_words, hits, items = [], [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for chunk in W.chunks(batch["text"], word, lower):
                n_words.append(np.diff(chunk.bounds))
                start, window = occurrences(chunk, index)
                rows = np.searchsorted(chunk.bounds, start, side="right") - 1
                for row in np.unique(rows):
                    mine, first = rows == row, chunk.bounds[row]
                    covered = np.zeros(chunk.bounds[row + 1] - first, bool)
                    for s, w in zip(start[mine], window[mine]):
                        covered[s - first:s - first + index.length[w]] = True
                    hits[chunk.first + row] = ranges(covered)
                    items[chunk.first + row] = sorted({x for w in window[mine] for x in index.items[w]})
            n_words = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.record_batch({
                key: batch[key], "n_words": pa.array(n_words, pa.int64()),
                "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "items": pa.array(items, pa.list_(pa.string()))})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(scan, f"{key} {kind}, n_words bigint, hits {_HITS}, items array<string>")


def _indexes(docs: DataFrame, bench: DataFrame, window: int, blocks: int, spark: SparkSession) -> Iterator[Index]:
    """One index per block of items; a block's items pass the driver, ``BLOCK_CHARS`` characters of them."""
    for block in range(blocks):
        mine = bench.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        windows = item_windows([tuple(r) for r in mine.collect()], window)
        vocabulary = np.unique(word_hashes(sorted({w for x in windows for w in x}))) if windows else np.zeros(0, np.uint64)
        yield build(windows, _frequencies(docs, vocabulary, spark) if windows else {})


def _items(benchmark: DataFrame, item_column: str, item_text: str, block_chars: int) -> tuple[DataFrame, int]:
    """The items with a text, and the number of blocks that they need."""
    bench = benchmark.select(F.col(item_column).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    return bench, 1 + (bench.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_column: str = "text",
                         item_column: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no item window occurs.

    Rows are judged where they are, one block of items after the other, so
    nothing is shuffled and ids do not matter; null texts stay.
    """
    spark = docs.sparkSession
    bench, blocks = _items(benchmark, item_column, item_text, block_chars)
    texts = docs.select(F.col(text_column).alias("text"))
    for index in _indexes(texts, bench, window, blocks, spark):
        docs = _filtered(docs, text_column, send(spark, index))
    return docs


def _filtered(docs: DataFrame, text_column: str, held) -> DataFrame:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, lower, word = received(held), W.lower_ascii(), W.alphanumeric()
        for batch in rebatched(batches):
            keep = np.ones(batch.num_rows, bool)
            for chunk in W.chunks(batch.column(batch.schema.get_field_index(text_column)), word, lower):
                start, _ = occurrences(chunk, index)
                keep[chunk.first + np.searchsorted(chunk.bounds, start, side="right") - 1] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id``, ``n_words``, the word ranges ``hits`` covered by item windows, and the ids of their ``items``.

    Items without words match nothing, and so does an empty benchmark.
    """
    spark = docs.sparkSession
    docs = id_text(docs, id_column, text_column)
    bench, blocks = _items(benchmark, item_column, item_text, block_chars)
    if blocks > 1:
        docs = stored(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    parts = [_scan(docs, index, "doc_id" if blocks == 1 else "row", spark) for index in _indexes(docs, bench, window, blocks, spark)]
    if blocks == 1:
        return parts[0]
    joined = reduce(DataFrame.unionAll, parts).groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return docs.select("row", "doc_id").join(joined, "row").select("doc_id", "n_words", _merged("hits").alias("hits"), "items")


def _merged(hits: str):
    """Ranges of several blocks as disjoint ranges in order."""
    return F.expr(f"""
        aggregate(array_sort({hits}), cast(array() AS {_HITS}), (done, x) ->
            CASE WHEN size(done) > 0 AND element_at(done, -1).end >= x.start
                 THEN concat(slice(done, 1, size(done) - 1),
                             array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, x.end))))
                 ELSE concat(done, array(x)) END)""")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``contamination``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))

