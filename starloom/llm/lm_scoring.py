"""LM scoring with a log-frequency Bloom filter.

Counts of words and of word pairs are quantised to powers of two; an entry of
level ``l`` is put into the filter once for each level up to ``l``, and read
back by probing level after level until one misses. Filter segments hold
disjoint ranges of hashed entries and are built by separate tasks; the filter
grows with the number of entries. Up to ``MAX_PART`` bytes of it are sent to
the workers at once; a larger filter is sent in parts, one pass over the texts
for each, which keep the levels they found.

The pair probability is mixed with the word's: ``s c2 / c1 + (1 - s) p1``, where
``s`` is the share of training tokens whose pair is found elsewhere, too. Pairs
found once are in the filter like all others.

Beside the model's score there is an exact unigram score. Its counts are not
quantised: words above a ``HEAVY``-th of all tokens (so at most ``HEAVY`` of
them) are sent to the texts, the others meet their counts in a join.

A null text is empty and has the end token only. Words are 64-bit hashes. Ids
are unique but for repeated rows; a row without id is known by its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F

from starloom.llm import words as W
from starloom.llm.tables import Scratch, keyed, rebatched, received, send

SEGMENT_BITS = 1 << 19
SEGMENT_BYTES = SEGMENT_BITS // 8
#: Filter bits for each level of an entry; three probes miss wrongly in about one of 130 cases.
ENTRY_BITS = 14
MAX_PART = 128 << 20
HEAVY = 65_536
_START, _END = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)
_PAIR, _LEVEL = np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)


def tokens(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end token after each row, and the rows' bounds."""
    return np.insert(chunk.hashes(), chunk.bounds[1:], _END), chunk.bounds + np.arange(chunk.rows + 1)


def pairs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it in its row."""
    before = np.concatenate([[_START], words[:-1]])
    before[bounds[:-1]] = _START
    return W.mix(before * _PAIR + words)


class Sums:
    """Sums by 64-bit key inside a task; parts are merged when many wait."""

    LIMIT = 1_000_000

    def __init__(self, width: int):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.width, self.waiting = width, 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        found, which = np.unique(keys, return_inverse=True)
        sums = np.column_stack([np.bincount(which, weights=values[:, i], minlength=len(found)) for i in range(self.width)])
        self.parts.append((found, sums.astype(np.int64)))
        self.waiting += len(found)

    def full(self) -> bool:
        if self.waiting > 2 * self.LIMIT:
            self.parts = [self.merged()]
            self.waiting = len(self.parts[0][0])
            return self.waiting > self.LIMIT
        return False

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts]) if self.parts else np.zeros(0, np.uint64)
        values = np.concatenate([v for _, v in self.parts]) if self.parts else np.zeros((0, self.width), np.int64)
        found, which = np.unique(keys, return_inverse=True)
        sums = [np.bincount(which, weights=values[:, i], minlength=len(found)) for i in range(self.width)]
        return found, np.column_stack(sums).astype(np.int64) if len(found) else values

    def batch(self, names: list[str]) -> pa.RecordBatch:
        keys, sums = self.merged()
        self.parts, self.waiting = [], 0
        return pa.record_batch([pa.array(keys.view(np.int64)), *(pa.array(np.ascontiguousarray(sums[:, i])) for i in range(self.width))], names=names)


def _word_counts(docs: DataFrame) -> DataFrame:
    """``word``, occurrences in all documents and in the training ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(2)
        for batch in rebatched(batches):
            train = batch["train"].to_numpy(zero_copy_only=False)
            for chunk in W.chunks(batch["text"], W.space_separated(), W.lower_ascii()):
                words, bounds = tokens(chunk)
                flag = np.repeat(train[chunk.first:chunk.first + chunk.rows], np.diff(bounds))
                sums.add(words, np.column_stack([np.ones(len(words)), flag]))
                if sums.full():
                    yield sums.batch(["word", "n", "train_n"])
        yield sums.batch(["word", "n", "train_n"])

    return docs.select("text", "train").mapInArrow(run, "word bigint, n bigint, train_n bigint").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("train_n").alias("train_n"))


def _pair_counts(docs: DataFrame) -> DataFrame:
    """``entry`` and occurrences of the pairs of the training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(1)
        for batch in rebatched(batches):
            for chunk in W.chunks(batch["text"], W.space_separated(), W.lower_ascii()):
                found = pairs(*tokens(chunk))
                sums.add(found, np.ones((len(found), 1)))
                if sums.full():
                    yield sums.batch(["entry", "n"])
        yield sums.batch(["entry", "n"])

    return docs.where("train").select("text").mapInArrow(run, "entry bigint, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))


def hashed(entries: np.ndarray, level: int) -> np.ndarray:
    """The hash of an entry's level."""
    return W.mix(entries + np.uint64(int(_LEVEL) * level & 0xFFFFFFFFFFFFFFFF))


def place(h: np.ndarray, i: int) -> np.ndarray:
    """Bit ``i`` of the three, inside its segment, from that hash."""
    return ((h >> np.uint64(19 * i)) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64)


def places(entries: np.ndarray, level: int) -> list[np.ndarray]:
    """The three bits of an entry's level inside its segment, from one hash."""
    h = hashed(entries, level)
    return [place(h, i) for i in range(3)]


def _segments(entries: DataFrame, segments: int) -> DataFrame:
    """``segment`` and its bits from ``entry`` and ``level``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in rebatched(batches, 100_000):
            segment, level = batch["segment"].to_numpy(), batch["level"].to_numpy()
            entry = batch["entry"].to_numpy().view(np.uint64)
            for number in np.unique(segment):
                mine = bits.setdefault(int(number), np.zeros(SEGMENT_BITS, bool))
                here, upto = entry[segment == number], level[segment == number]
                for at in range(1, int(upto.max()) + 1):
                    for place in places(here[upto >= at], at):
                        mine[place] = True
        for number, mine in bits.items():
            yield pa.record_batch({"segment": pa.array([number], pa.int64()),
                                   "bits": pa.array([np.packbits(mine, bitorder="little").tobytes()], pa.binary())})

    placed = entries.withColumn("segment", F.pmod("entry", F.lit(segments)))
    return placed.repartition(segments // 16 + 1, "segment").mapInArrow(run, "segment bigint, bits binary")


def levels(entries: np.ndarray, bits: np.ndarray, low: int, segments: int, into: np.ndarray) -> None:
    """Reads the levels of the entries whose segments are ``low`` and on into ``into``."""
    found, which = np.unique(entries, return_inverse=True)
    segment = found.view(np.int64) % segments - low
    out = np.zeros(len(found), np.uint8)
    mine = (segment >= 0) & (segment < len(bits))
    alive = np.flatnonzero(mine)
    flat, keys, base = bits.reshape(-1), found[alive], segment[alive] * SEGMENT_BYTES
    level = 1
    while len(alive) and level < 60:
        h = hashed(keys, level)
        for i in range(3):  # what one bit rules out is not looked up again
            at = place(h, i)
            hit = np.flatnonzero((flat[base + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1)
            if len(hit) < len(keys):
                alive, keys, base, h = alive[hit], keys[hit], base[hit], h[hit]
        out[alive] = level
        level += 1
    here = mine[which]
    into[here] = out[which][here]


def middle(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; level one is a count of one."""
    low = 2.0 ** (level.astype(np.float64) - 1)
    return np.where(level > 0, (low + 2 * low - 1) / 2, 0.0)


def _scored(docs: DataFrame, filter_bits: np.ndarray, low: int, segments: int, last: bool, model: dict) -> DataFrame:
    """One pass with the segments from ``low`` on; the last one turns levels into scores."""
    spark = docs.sparkSession
    held, facts = spark.sparkContext.broadcast(filter_bits), send(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, facts_ = held.value, received(facts)
        for batch in rebatched(batches, 1000):
            found: tuple[list, list] = ([], [])
            rows: list[tuple] = []
            for chunk in W.chunks(batch["text"], W.space_separated(), W.lower_ascii()):
                words, bounds = tokens(chunk)
                two = []
                for name, entries in (("one", words), ("two", pairs(words, bounds))):
                    level = np.zeros(len(entries), np.uint8)
                    if low:
                        kept = batch[name].slice(chunk.first, chunk.rows).to_pylist()
                        level = np.frombuffer(b"".join(kept), np.uint8).copy()
                    levels(entries, bits, low, segments, level)
                    two.append(level)
                if last:
                    rows += _log_probabilities(words, bounds, two[0], two[1], facts_)
                else:
                    for store, level in zip(found, two):
                        store.extend(level[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:]))
            kept = [batch[c] for c in ("id", "doc_id", "train")]
            if last:
                kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int64())
                columns = list(zip(*rows)) or [()] * 4
                yield pa.record_batch([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                      names=["id", "doc_id", "train", "n_tokens", "score", "heavy_base", "heavy_known"])
            else:
                yield pa.record_batch([*kept, batch["text"], *(pa.array(s, pa.binary()) for s in found)],
                                      names=["id", "doc_id", "train", "text", "one", "two"])

    head = "id bigint, doc_id bigint, train boolean, "
    return docs.mapInArrow(run, head + ("n_tokens bigint, score double, heavy_base double, heavy_known bigint" if last
                                        else "text string, one binary, two binary"))


def _log_probabilities(words: np.ndarray, bounds: np.ndarray, one: np.ndarray, two: np.ndarray, model: dict) -> list[tuple]:
    """Tokens, model score, exact score and known tokens of the heavy words, by row."""
    size, first = np.diff(bounds), bounds[:-1]
    below = model["tokens"] + 0.5 * (model["distinct"] + 1)
    c1 = middle(one)
    p1 = (c1 + 0.5) / below
    history = np.concatenate([[0.0], c1[:-1]])
    history[first] = model["documents"]
    c2 = np.minimum(middle(two), np.maximum(history, c1))
    share = np.where(history > 0, model["share"], 0.0)
    p = np.log10(share * c2 / np.maximum(np.maximum(history, c2), 1) + (1 - share) * p1)
    # each word of the chunk is looked up once
    found, which = np.unique(words, return_inverse=True)
    at = np.minimum(np.searchsorted(model["heavy"], found), max(0, len(model["heavy"]) - 1))
    heavy = model["heavy"][at] == found if len(model["heavy"]) else np.zeros(len(found), bool)
    c = model["heavy_n"][at] if len(model["heavy"]) else np.zeros(len(found))
    base = np.where(heavy, np.log10((c + 0.5) / below), 0.0)[which]
    known = (heavy & (c > 0))[which]
    if not len(size):
        return []
    return list(zip(size.tolist(), np.add.reduceat(p, first).tolist(), np.add.reduceat(base, first).tolist(),
                    np.add.reduceat(known, first, dtype=np.int64).tolist()))


def _light(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """``doc_id``, ``word``, ``times`` of the words that are not heavy."""
    held = send(docs.sparkSession, heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = received(held)
        for batch in rebatched(batches):
            ids = batch["doc_id"].to_numpy()
            for chunk in W.chunks(batch["text"], W.space_separated(), W.lower_ascii()):
                words, bounds = tokens(chunk)
                row = np.repeat(np.arange(chunk.rows), np.diff(bounds))
                found, which = np.unique(words, return_inverse=True)
                if len(heavy):
                    light = (heavy[np.minimum(np.searchsorted(heavy, found), len(heavy) - 1)] != found)[which]
                    which, row = which[light], row[light]
                cells, times = np.unique(row * max(1, len(found)) + which, return_counts=True)
                row, which = np.divmod(cells, max(1, len(found)))
                yield pa.record_batch({
                    "doc_id": pa.array(ids[chunk.first + row]), "word": pa.array(found[which].view(np.int64)),
                    "times": pa.array(times.astype(np.int32))})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, word bigint, times int")


def scored(docs: DataFrame, train: str, id_column: str = "doc_id", text_column: str = "text", max_part: int = MAX_PART) -> DataFrame:
    """Every document with both scores, learned from the rows where the SQL condition ``train`` holds."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    docs = keyed(docs, id_column, text_column, F.expr(train).alias("train"))
    words = scratch.store(_word_counts(docs), "words")
    totals = words.agg(F.sum("n").alias("all"), F.sum("train_n").alias("tokens"), F.sum(F.sign("train_n").cast("long")).alias("distinct")).first()
    n_tokens, distinct = totals["tokens"] or 0, totals["distinct"] or 0
    end = words.where(F.col("word") == F.lit(int(_END.view(np.int64)))).first()
    heavy = words.where(F.col("n") >= F.lit(max(2, (totals["all"] or 0) // HEAVY + 1))).toArrow()
    order = np.argsort(heavy["word"].to_numpy().view(np.uint64))
    model = {"tokens": n_tokens, "distinct": distinct, "documents": end["train_n"] if end else 0,
             "share": 0.0, "heavy": heavy["word"].to_numpy().view(np.uint64)[order], "heavy_n": heavy["train_n"].to_numpy()[order]}
    log2 = lambda c: F.floor(F.log2(F.col(c).cast("double")) + F.lit(1e-9)).cast("int")
    seen = Observation("pairs")
    counts = _pair_counts(docs).observe(seen, F.count_if(F.col("n") == 1).alias("once"), F.sum("n").alias("all"))
    found = scratch.store(counts.select("entry", (log2("n") + 1).alias("level")), "pairs")
    if seen.get["all"]:
        model["share"] = min(0.95, 1 - seen.get["once"] / seen.get["all"])
    entries = words.where("train_n > 0").select(F.col("word").alias("entry"), (log2("train_n") + 1).alias("level")).unionAll(found)
    weight = entries.agg(F.sum("level")).first()[0] or 0
    segments = max(1, -(-weight * ENTRY_BITS // SEGMENT_BITS))
    table = scratch.store(_segments(entries, segments), "filter")
    step = max(1, max_part // SEGMENT_BYTES)
    rows = docs
    for low in range(0, segments, step):
        part = table.where((F.col("segment") >= low) & (F.col("segment") < low + step)).toArrow()
        bits = np.zeros((min(step, segments - low), SEGMENT_BYTES), np.uint8)
        for number, one in zip(part["segment"].to_pylist(), part["bits"]):
            bits[number - low] = np.frombuffer(one.as_buffer(), np.uint8)
        last = low + step >= segments
        rows = _scored(rows, bits, low, segments, last, model)
        rows = rows if last else scratch.store(rows, "levels")
    rows = scratch.store(rows, "scores")
    below = F.lit(float(n_tokens + 0.5 * (distinct + 1)))
    light = _light(docs, model["heavy"]).join(words.select("word", "train_n"), "word").groupBy("doc_id").agg(
        F.sum(F.col("times") * F.log10((F.col("train_n") + 0.5) / below)).alias("light_base"),
        F.sum(F.when(F.col("train_n") > 0, F.col("times")).otherwise(0)).alias("light_known"))
    copies = rows.groupBy("doc_id").agg(F.count("*").alias("copies"))
    sums = light.join(copies, "doc_id").select(
        "doc_id", (F.col("light_base") / F.col("copies")).alias("light_base"), F.expr("light_known DIV copies").alias("light_known"))
    return rows.join(sums, "doc_id", "left").select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("heavy_known") + F.coalesce("light_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("heavy_base") + F.coalesce("light_base", F.lit(0.0))).alias("base_score"), "score")
