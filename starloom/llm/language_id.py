"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language and bucket inside the tasks and adds the
counts up by a shuffle; the matrix of log probabilities has ``BUCKETS`` rows and
a column per language, so its size does not follow the data. Scoring gathers
the matrix rows of a text's n-grams and sums them, a batch of texts at a time.

A null text, or one without any letter, is ``und`` with score 0. Ties go to the
alphabetically first language. Without training rows everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.llm.tables import rebatched, received, send

BUCKETS = 1 << 15
ORDERS = (2, 3)
#: Characters of one scoring step, times the number of languages.
STEP = 1_000_000
#: More languages than this are refused: the matrix is sent to every worker (128 kB a language).
MAX_LANGUAGES = 512
SMOOTHING = 0.5
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """True at each code point that is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_chunks(texts: pa.Array, step: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Rows, where each row's characters begin, letter marks, and bucket numbers per order.

    Texts are lower-cased, everything but letters becomes a space; each text
    stands between spaces, and n-grams that reach into the next text lie in the
    space between two texts only.
    """
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 3
    total, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + step, side="right")))
        joined = "".join(f" {t}  " for t in texts.slice(first, last - first).to_pylist())
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], total[first:last] - before])
        letter = letters()[codes]
        codes = np.where(letter, codes, 32).astype(np.uint64)
        grams = []
        for order in ORDERS:
            h = np.full(len(codes) - order + 1, order, np.uint64)
            for j in range(order):
                h = h * np.uint64(31) + codes[j:len(codes) - order + 1 + j] * _FACTORS[j]
            h ^= h >> np.uint64(15)
            h *= np.uint64(0x2C1B3C6D)
            grams.append(((h >> np.uint64(12)) % np.uint64(BUCKETS)).astype(np.int32))
        yield slice(first, last), at, letter, grams
        first = last


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray
    matrix: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Most probable language and its posterior probability."""
        n = len(texts)
        names, scores = ["und"] * n, np.zeros(n)
        if not self.languages:
            return names, scores
        for rows, at, letter, grams in gram_chunks(texts, max(1, STEP // len(self.languages))):
            sums = np.tile(self.prior, (rows.stop - rows.start, 1))
            for h in grams:
                sums += np.add.reduceat(self.matrix[h], at[:-1], axis=0, dtype=np.float64)
            some = np.add.reduceat(letter, at[:-1], dtype=np.int64) > 0
            best = sums.argmax(axis=1)
            share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            for i in np.flatnonzero(some):
                names[rows.start + i], scores[rows.start + i] = self.languages[best[i]], share[i]
        return names, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(lang, bucket, n)`` of a task; bucket -1 counts texts."""
    counts: dict[str, np.ndarray] = {}

    def emit():
        for lang, sums in counts.items():
            some = np.flatnonzero(sums)
            yield pa.record_batch({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(some)),
                                   "bucket": pa.array(some - 1, pa.int32()), "n": pa.array(sums[some], pa.int64())})
        counts.clear()

    for batch in rebatched(batches):
        langs = batch["lang"].to_pylist()
        for rows, at, _, grams in gram_chunks(batch["text"], STEP):
            names = sorted(set(langs[rows]))
            number = {name: i for i, name in enumerate(names)}
            of_row = np.array([number[x] for x in langs[rows]])
            of_char = np.repeat(of_row, np.diff(at))
            for name in names:
                mine = counts.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                mine[0] += int((of_row == number[name]).sum())
                for h in grams:
                    mine[1:] += np.bincount(h[of_char[:len(h)] == number[name]], minlength=BUCKETS)
            if len(counts) > 64:
                yield from emit()
    yield from emit()


def train(rows: DataFrame, text_column: str = "text", lang_column: str = "lang") -> Model:
    """Fits the model to all rows with a text and a language."""
    rows = rows.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.limit((BUCKETS + 1) * MAX_LANGUAGES + 1).toArrow()
    if found.num_rows > (BUCKETS + 1) * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(set(found["lang"].to_pylist()))
    counts = np.zeros((BUCKETS + 1, len(names)))
    number = {name: i for i, name in enumerate(names)}
    counts[found["bucket"].to_numpy() + 1, [number[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    grams = counts[1:] + SMOOTHING
    return Model(tuple(names), np.log(counts[0] / max(1, counts[0].sum())),
                 np.log(grams / grams.sum(axis=0)).astype(np.float32))


def identify(spark: SparkSession, docs: DataFrame, model: Model, text_column: str = "text",
             lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """All columns of ``docs`` with the predicted language and its probability."""
    held = send(spark, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(held)
        for batch in rebatched(batches):
            names, scores = model.predict(batch[text_column])
            yield pa.record_batch([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  names=[*batch.schema.names, lang_name, score_name])

    plain = docs.select(*[f"`{c}`" for c in docs.columns if c not in (lang_name, score_name)])
    schema = T.StructType([*plain.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())])
    return plain.mapInArrow(score, schema)
