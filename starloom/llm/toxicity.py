"""Toxicity: a learned lexicon, found also when misspelled, judged in its context.

1. Lexicon. Words of labelled texts are counted by toxic and clean documents,
   and all words that speak for toxicity are kept with their log odds.
2. Matching. The terms form a trie (one for each block of ``BLOCK`` terms, walked
   in turn). Its paths are walked with a Levenshtein
   automaton (one error) of every distinct word of a chunk at once: the states
   of all automata are bit vectors in one array, and words whose automaton has
   died leave the walk.
3. Context. Matches inside quotation marks, or near a word of reporting and
   without an address, count as quoted, others as abuse.
4. A logistic regression over the sums of both kinds gives the score.

Null and empty texts have no matches and get the score of a text without any.
Without labelled rows of both kinds every score is the share of toxic labels
(0 without labels). Repeated rows each get their own score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from starloom.llm import words as W
from starloom.llm.tables import BROADCAST_IDS, rebatched, received, send, stored

#: Longest word the automata take; bit vectors have 64 bits and sums of powers stay exact.
MAX_LENGTH = 40
#: Shortest term that is also matched with an error.
FUZZY_FROM = 5
#: Words on either side of a match that are its context.
WINDOW = 6
#: Terms of one trie; a larger lexicon is matched block by block.
BLOCK = 20_000
#: Words of reporting and of address (fixed lists).
REPORTING = ("said", "says", "wrote", "writes", "called", "quote", "quoted", "quoting", "term", "word", "insult", "slur",
             "sagte", "schrieb", "zitat", "dit", "écrit", "citation", "dijo", "escribió", "cita")
ADDRESS = ("you", "your", "youre", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "votre", "tú", "usted", "vosotros")
_QUOTES = "[“”„«»‹›]"


def folded(texts: pa.Array) -> pa.Array:
    """Lower-case texts with plain quotation marks."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _QUOTES, ' " ')


@dataclass
class Node:
    next: dict[int, "Node"] = field(default_factory=dict)
    term: int = -1


def trie(terms: list[str]) -> Node:
    root = Node()
    for number, term in enumerate(terms):
        node = root
        for char in term:
            node = node.next.setdefault(ord(char), Node())
        node.term = number
    return root


def intersect(root: Node, terms: list[str], words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(term, exact words, words at distance one)`` for the terms that some word matches.

    Bit ``i`` of ``r0`` (``r1``) says that the first ``i`` characters of a word
    match the walked path with no (at most one) error.
    """
    if not words:
        return
    size = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    of = np.repeat(np.arange(len(words)), size)
    bit = np.exp2(np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size))
    order = np.argsort(codes, kind="stable")
    alphabet, at = np.unique(codes[order], return_index=True)
    at = np.append(at, len(codes))
    masks: dict[int, np.ndarray] = {}

    def mask(char: int) -> np.ndarray:
        if char not in masks:
            k = int(np.searchsorted(alphabet, char))
            here = order[at[k]:at[k + 1]] if k < len(alphabet) and alphabet[k] == char else order[:0]
            masks[char] = np.bincount(of[here], weights=bit[here], minlength=len(words)).astype(np.uint64)
        return masks[char]

    one, last = np.uint64(1), np.left_shift(np.uint64(1), size.astype(np.uint64))
    valid = (last << one) - one
    everyone = np.arange(len(words))
    stack = [(root, everyone, np.ones(len(words), np.uint64), np.full(len(words), 3, np.uint64))]
    while stack:
        node, who, r0, r1 = stack.pop()
        if node.term >= 0:
            end = last[who]
            exact = (r0 & end) != 0
            near = ((r1 & end) != 0) & ~exact if len(terms[node.term]) >= FUZZY_FROM else np.zeros(len(who), bool)
            if exact.any() or near.any():
                yield node.term, who[exact], who[near]
        for char, child in node.next.items():
            m = mask(char)[who]
            s0 = (r0 & m) << one
            s1 = ((r1 & m) << one) | r0 | (r0 << one) | (s0 << one)
            s0, s1 = s0 & valid[who], s1 & valid[who]
            alive = (s0 | s1) != 0
            if alive.any():
                stack.append((child, who[alive], s0[alive], s1[alive]))


@dataclass
class Lexicon:
    """Terms with the weight of an exact match and of one with an error."""

    terms: list[str]
    weight: np.ndarray


FEATURES = ("abuse", "misspelled", "quoted", "strongest", "density")


class Matcher:
    def __init__(self, lexicon: Lexicon, block: int = BLOCK):
        # neighbours in the alphabet share their paths
        order = sorted(range(len(lexicon.terms)), key=lexicon.terms.__getitem__)
        self.blocks = [Lexicon([lexicon.terms[i] for i in order[low:low + block]], lexicon.weight[order[low:low + block]])
                       for low in range(0, len(order), block)]
        self.root = trie(self.blocks[0].terms) if len(self.blocks) == 1 else None
        self.reporting, self.address = (_hashes(x) for x in (REPORTING, ADDRESS))

    def features(self, texts: pa.Array) -> np.ndarray:
        """A row of ``FEATURES`` per text."""
        out = [np.zeros((0, len(FEATURES)))]
        for chunk in W.chunks(folded(texts), W.alphanumeric(), limit=2_000_000):
            out.append(self._chunk(chunk))
        return np.concatenate(out)

    def _chunk(self, chunk: W.Chunk) -> np.ndarray:
        out = np.zeros((chunk.rows, len(FEATURES)))
        hashes = chunk.hashes()
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        exact, near = np.zeros(len(distinct)), np.zeros(len(distinct))
        bytes_of = chunk.ends[first] - chunk.starts[first]
        kept = np.flatnonzero(bytes_of <= 4 * MAX_LENGTH)
        words = [chunk.word(i).decode(errors="replace") for i in first[kept]]
        short = [i for i, w in enumerate(words) if len(w) <= MAX_LENGTH]
        kept, words = kept[short], [words[i] for i in short]
        for block in self.blocks:
            # one of several tries is held at a time
            for term, same, one_off in intersect(self.root or trie(block.terms), block.terms, words):
                w = block.weight[term]
                exact[kept[same]] = np.maximum(exact[kept[same]], w)
                near[kept[one_off]] = np.maximum(near[kept[one_off]], w)
        near[exact > 0] = 0
        weight = (exact + near)[which]
        hits = np.flatnonzero(weight)
        if not len(hits):
            return out
        row = np.searchsorted(chunk.bounds, hits, side="right") - 1
        marks = np.concatenate([[0], np.cumsum(chunk.buf == 0x22)])
        inside = (marks[chunk.starts[hits]] - marks[chunk.text_at[row]]) % 2 == 1
        quoted = inside | (self._near(hashes, self.reporting, hits, row, chunk) & ~self._near(hashes, self.address, hits, row, chunk))
        fuzzy = near[which[hits]] > 0
        for column, mine in enumerate((~quoted & ~fuzzy, ~quoted & fuzzy, quoted)):
            out[:, column] = np.bincount(row[mine], weights=weight[hits[mine]], minlength=chunk.rows)
        np.maximum.at(out[:, 3], row, np.where(quoted, 0.5, 1) * np.where(fuzzy, 0.5, 1) * weight[hits])
        out[:, 4] = np.bincount(row, minlength=chunk.rows) / np.sqrt(np.maximum(1, np.diff(chunk.bounds)))
        out[:, :3] = np.log1p(out[:, :3])
        return out

    @staticmethod
    def _near(hashes: np.ndarray, listed: np.ndarray, hits: np.ndarray, row: np.ndarray, chunk: W.Chunk) -> np.ndarray:
        """Whether a listed word stands within the window of a match, in the same text."""
        seen = np.concatenate([[0], np.cumsum(np.isin(hashes, listed))])
        low = np.maximum(hits - WINDOW, chunk.bounds[row])
        high = np.minimum(hits + WINDOW + 1, chunk.bounds[row + 1])
        return seen[high] > seen[low]


def _hashes(words: tuple[str, ...]) -> np.ndarray:
    return next(W.chunks(pa.array([" ".join(words)]), W.alphanumeric())).hashes()


def _document_words(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, word) pairs of a chunk: the row and the place of the word."""
    hashes, row = chunk.hashes(), chunk.row_of_words()
    order = np.lexsort((hashes, row))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(row[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    return row[order[new]], order[new]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clean and toxic documents of each word, summed inside the task."""
    counts: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())

    def emit():
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.record_batch({"term": pa.array([w.decode(errors="replace") for w in terms], pa.string()),
                               "good": pa.array([counts[0][w] for w in terms], pa.int64()),
                               "bad": pa.array([counts[1][w] for w in terms], pa.int64())})
        for kind in counts:
            kind.clear()

    for batch in rebatched(batches):
        toxic = batch["toxic"].to_numpy()
        for chunk in W.chunks(folded(batch["text"]), W.alphanumeric()):
            row, place = _document_words(chunk)
            long = chunk.ends[place] - chunk.starts[place]
            kept = (long > 2) & (long <= MAX_LENGTH)
            row, place = row[kept], place[kept]
            marked = toxic[chunk.first + row] == 1
            for kind, mine in ((0, place[~marked]), (1, place[marked])):
                counts[kind].update(chunk.word(i) for i in mine)
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield from emit()
    yield from emit()


def learn_lexicon(rows: DataFrame, min_docs: int = 4, min_odds: float = 2.5) -> Lexicon:
    """Terms of ``rows`` (``text``, ``toxic``) that speak for toxicity.

    Every term in at least ``min_docs`` toxic documents whose smoothed log odds
    reach ``min_odds``: the test depends on the term's counts and the shares of
    the labels, not on the number of rows. Only the terms that pass it are collected.
    """
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Lexicon([], np.zeros(0))
    counts = rows.select("text", "toxic").mapInArrow(_term_counts, "term string, good bigint, bad bigint").groupBy("term").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")).where(F.col("bad") >= min_docs)
    odds = F.log((F.col("bad") + 0.1) / (bad + 1)) - F.log((F.col("good") + 0.3) / (good + 1))
    found = counts.select("term", "bad", odds.alias("odds")).where(F.col("odds") >= min_odds).toArrow().to_pydict()
    best = sorted(zip(found["term"], found["bad"], found["odds"]), key=lambda t: (-t[2] * t[1] ** 0.5, t[0]))
    return Lexicon([t for t, _, _ in best], np.array([o for _, _, o in best]))


@dataclass
class Model:
    lexicon: Lexicon
    center: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.center) / self.scale) @ self.coefficients[1:] + self.coefficients[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(lexicon: Lexicon, features: np.ndarray, toxic: np.ndarray, ridge: float = 1.0) -> Model:
    """Newton's method for a logistic regression with a small ridge."""
    k = len(FEATURES)
    center, scale = np.zeros(k), np.ones(k)
    share = toxic.mean() if len(toxic) else 0.0
    beta = np.zeros(k + 1)
    if share in (0.0, 1.0):
        beta[0] = 40.0 if share else -40.0
        return Model(lexicon, center, scale, beta)
    center = features.mean(axis=0)
    scale = np.where(features.std(axis=0) > 0, features.std(axis=0), 1)
    x = np.column_stack([np.ones(len(features)), (features - center) / scale])
    penalty = np.diag([1e-6, *[ridge] * k])
    beta[0] = np.log(share / (1 - share))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (toxic - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return Model(lexicon, center, scale, beta)


def _feature_rows(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``rows`` with ``features`` in place of ``text``."""
    held = send(rows.sparkSession, lexicon)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(received(held))
        for batch in rebatched(batches):
            found = matcher.features(batch["text"])
            yield pa.record_batch([*(batch[f.name] for f in kept), pa.array(list(found), pa.list_(pa.float64()))],
                                  names=[*(f.name for f in kept), "features"])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("features", T.ArrayType(T.DoubleType()))]))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 100_000) -> Model:
    """Learns from ``docs`` (``doc_id``, ``text``) with ``labels`` (``doc_id``, ``toxic``).

    The lexicon is counted over all labelled rows. The regression is fitted to
    a sample of at most ``fit_rows`` of them, drawn by a hash of the id. Up to
    ``BROADCAST_IDS`` labels are sent to the texts, which then stay where they
    are; of more, texts and labels are shuffled together once.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)").dropDuplicates(["doc_id"])
    total = marks.count()
    texts = docs.where("text IS NOT NULL")
    rows = texts.join(F.broadcast(marks), "doc_id") if total <= BROADCAST_IDS else stored(texts.join(marks, "doc_id"), "labelled")
    lexicon = learn_lexicon(rows.select("text", "toxic"))
    share = min(1.0, 0.8 * fit_rows / max(1, total))
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # the bound is put on the narrow feature rows, as it gathers them in one task
    found = _feature_rows(sample.select("toxic", "text"), lexicon).limit(fit_rows).toArrow()
    features = np.array(found["features"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(lexicon, features, found["toxic"].to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of ``docs`` but its text, with ``score``, ``predicted`` and the match ``features``."""
    held = send(docs.sparkSession, (model.lexicon, model))
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, model = received(held)
        matcher = Matcher(lexicon)
        for batch in rebatched(batches):
            found = matcher.features(batch["text"])
            scores = model.score(found)
            yield pa.record_batch(
                [*(batch[f.name] for f in kept), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                 pa.array(list(found), pa.list_(pa.float64()))],
                names=[*(f.name for f in kept), "score", "predicted", "features"])

    return docs.mapInArrow(run, T.StructType([
        *kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("features", T.ArrayType(T.DoubleType()))]))


