"""Packing of token sequences: vector bin packing under several limits at once.

Every task tokenises its documents and packs them as it goes. An open sequence
takes, of the pieces that fit, the one with the largest dot product of its
demand (tokens, segments, loss-bearing tokens, each as a share of the limit)
and the sequence's free room. When none fits whole, the best one is cut to fill
the room. A task's last tokens fill sequences of descending powers of two,
which need no padding. Nothing is shuffled; sequence ids hold the partition.

A null text is empty and has its end id only; rows with equal ids are packed
each on its own. Columns besides id and text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starloom.llm import words as W
from starloom.llm.tables import id_text, rebatched

#: Words whose ids a task remembers (about 60 bytes each), and runs of letters (200).
REMEMBERED, REMEMBERED_RUNS = 250_000, 100_000
#: Tokens that wait in a task before sequences are filled from them.
WAITING = 400_000
#: Words of letters that have one lower-case form of one code point, and a mark that is a token of its own after them.
PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,]?)")


def byte_alphabet() -> dict[int, str]:
    """One visible character per byte, as byte-level tokenizers write them."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@cache
def tokenizer(path: str) -> tuple:
    """The tokenizer, its normaliser and splitter, those that take runs of letters as they are, and which ids end a word.

    A worker process loads it once, and switches the parts instead of holding
    two vocabularies. The last is None if the ends of words are not marked.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    found, ends = Tokenizer.from_file(path), None
    suffix = getattr(found.model, "end_of_word_suffix", None)
    if suffix:
        vocabulary = found.get_vocab()
        ends = np.zeros(1 + max(vocabulary.values()), bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return found, (found.normalizer, found.pre_tokenizer), (normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()), ends


class WordIds:
    """Token ids of texts whose tokenizer never joins characters across white space.

    Distinct words are encoded once and remembered; a text's ids are those of
    its words in order, then ``end_id``. Plain words skip the tokenizer's
    normalising and splitting, if some trials agree: it then lower-cases, takes
    a run of letters as one piece, writes bytes as characters, and marks the
    last id of a word, which tells many runs encoded at once apart.
    """

    def __init__(self, path: str, end_id: int):
        self.tokenizer, self.whole, self.runs, self.ends = tokenizer(path)
        self.end_id, self.separators = end_id, W.space_separated()
        self.tail = {"": (), **{x: tuple(self.tokenizer.encode(x, add_special_tokens=False).ids) for x in ".,"}}
        self.bytes_apart = {b: c for b, c in byte_alphabet().items() if b != 0x20}  # a space stands between runs
        self.forget()
        ids = lambda word: tuple(self.tokenizer.encode(word, add_special_tokens=False).ids)
        trials = ["word", "naïve", "àéí", "straße", "qzxj", "a"]
        self.plain = self.ends is not None and self._learn(trials) and all(
            self.core[w] == ids(w) == ids(w.title()) and all(ids(w + x) == self.core[w] + self.tail[x] for x in ".,") for w in trials)

    def forget(self) -> None:
        self.core: dict[str, tuple] = {}
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool = np.array([self.end_id], np.uint32)  # slot 0 is the end id
        self.at, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _encode(self, words: list[str]) -> list[tuple]:
        out: list = [None] * len(words)
        other, cores, tails = [], [], []
        for i, word in enumerate(words):
            plain = PLAIN.fullmatch(word) if self.plain else None
            if plain is None:
                other.append(i)
            else:
                cores.append(plain[1].lower())
                tails.append((i, plain[2]))
        if len(self.core) > REMEMBERED_RUNS:
            self.core.clear()
        if not self._learn(list({core: None for core in cores if core not in self.core})):
            raise ValueError("the tokenizer marks the ends of some words only")
        for (i, tail), core in zip(tails, cores):
            out[i] = self.core[core] + self.tail[tail] if tail else self.core[core]
        for at in range(0, len(other), 2000):
            part = other[at:at + 2000]
            for i, found in zip(part, self.tokenizer.encode_batch([words[i] for i in part], add_special_tokens=False)):
                out[i] = tuple(found.ids)
        return out

    def _learn(self, cores: list[str]) -> bool:
        """Encodes lower-case runs of letters, many at once; False if their ids cannot be told apart."""
        parts = [cores[at:at + 50] for at in range(0, len(cores), 50)]
        texts = [" ".join(part).encode().decode("latin-1").translate(self.bytes_apart) for part in parts]
        try:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.runs
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        finally:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.whole
        for part, found in zip(parts, encoded):
            ids = found.ids
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(part):
                return False
            self.core.update((core, tuple(ids[a:b])) for core, a, b in zip(part, [0, *ends[:-1]], ends))
        return True

    def _slots(self, hashes: np.ndarray, chunk: W.Chunk, first: np.ndarray) -> np.ndarray:
        """Slots of distinct words; new ones are encoded."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            encoded = self._encode([chunk.word(i).decode() for i in first[new]])
            size = np.fromiter(map(len, encoded), np.int64, len(encoded))
            slots = len(self.at) + np.arange(len(encoded))
            self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(encoded), np.uint32, int(size.sum()))])
            place = np.searchsorted(self.known, hashes[new])  # both are sorted
            self.known, self.slot = np.insert(self.known, place, hashes[new]), np.insert(self.slot, place, slots)
        return self.slot[np.searchsorted(self.known, hashes)]

    def rows(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        for chunk in W.chunks(texts, self.separators, limit=1_000_000):
            if len(self.known) > REMEMBERED:
                self.forget()
            distinct, first, which = np.unique(chunk.hashes(), return_index=True, return_inverse=True)
            slots = self._slots(distinct, chunk, first)[which] if len(distinct) else np.zeros(0, np.int64)
            slots = np.insert(slots, chunk.bounds[1:], 0)
            size = self.size[slots]
            ends = np.cumsum(size)
            ids = self.pool[np.repeat(self.at[slots] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
            cut = ends[chunk.bounds[1:] + np.arange(chunk.rows)]
            for start, end in zip(np.concatenate([[0], cut[:-1]]), cut):
                yield ids[start:end].copy()


class Packer:
    """Fills sequences from the pieces that were added; ``pieces`` holds what was placed.

    The first ``prompt`` ids of a document bear no loss.
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, first_sequence: int):
        self.limits = np.array([max_tokens, max_segments, max_loss], np.float64)
        self.sequence = first_sequence
        self.pieces: list[tuple] = []
        self.docs: list[tuple] = []
        self.start = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int64)
        self.loss = np.zeros(0, np.int64)
        self.waiting = 0

    def add(self, docs: list[tuple]) -> None:
        """Documents ``(key, ids, prompt)``; ``key`` comes back with each piece."""
        size = np.array([len(ids) for _, ids, _ in docs], np.int64)
        self.docs += docs
        self.start = np.concatenate([self.start, np.zeros(len(docs), np.int64)])
        self.tokens = np.concatenate([self.tokens, size])
        self.loss = np.concatenate([self.loss, size - np.minimum(size, [p for *_, p in docs])])
        self.waiting += int(size.sum())

    def _place(self, item: int, length: int, offset: int) -> int:
        """Places the first ``length`` ids of what is left of an item; returns their loss."""
        key, ids, _ = self.docs[item]
        start, left = int(self.start[item]), int(self.tokens[item])
        loss = max(0, length - (left - int(self.loss[item])))
        part = np.ascontiguousarray(ids[start:start + length], "<u4")
        self.pieces.append((key, start, length, zlib.crc32(part.tobytes()), len(ids), self.sequence, offset))
        self.start[item] += length
        self.tokens[item] -= length
        self.loss[item] -= loss
        self.waiting -= length
        return loss

    def _fill(self, capacity: int) -> None:
        """Fills one sequence of up to ``capacity`` tokens."""
        room, offset = np.minimum(self.limits, [capacity, np.inf, np.inf]), 0
        while room[0] >= 1 and room[1] >= 1 and self.waiting:
            alive = self.tokens > 0
            weight = room / self.limits ** 2
            value = self.tokens * weight[0] + self.loss * weight[2]  # a segment counts the same for every piece
            fits = alive & (self.tokens <= room[0]) & (self.loss <= room[2])
            if fits.any():
                item = int(np.argmax(np.where(fits, value, -1)))
                length = int(self.tokens[item])
            else:
                free = np.minimum(self.tokens, np.minimum(room[0], self.tokens - self.loss + room[2]))
                item = int(np.argmax(np.where(alive, free * len(value) + (value > 0), -1)))
                length = int(free[item])
                if length < 1:
                    break
            loss = self._place(item, length, offset)
            room -= [length, 1, loss]
            offset += length
        self.sequence += 1

    def _tidy(self) -> None:
        keep = np.flatnonzero(self.tokens > 0)
        self.docs = [self.docs[i] for i in keep]
        self.start, self.tokens, self.loss = self.start[keep], self.tokens[keep], self.loss[keep]

    def run(self, last: bool) -> list[tuple]:
        """Fills whole sequences; at the ``last`` call everything is placed."""
        full = int(self.limits[0])
        used = 0
        while self.waiting >= full:
            self._fill(full)
            used += 1
            if used % 64 == 0:
                self._tidy()
        while last and self.waiting:
            self._fill(1 << (self.waiting.bit_length() - 1))
        self._tidy()
        out, self.pieces = self.pieces, []
        return out


PIECES = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint")
_FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2,
         max_tokens: int = 4096, max_segments: int = 512, max_loss: int = 4096, prompt_column: str | None = None) -> DataFrame:
    """One row per piece: its document, place in it, and place in a sequence.

    ``prompt_column`` gives the number of leading ids that bear no loss. The
    limits hold for every sequence; a sequence that reaches another limit
    before its tokens is padded.
    """
    prompt = F.coalesce(F.col(prompt_column).cast("long"), F.lit(0)) if prompt_column else F.lit(0).cast("long")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), prompt.alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer_path, end_id)
        packer = Packer(max_tokens, max_segments, max_loss, TaskContext.get().partitionId() << 40)

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces)) or [()] * 7
            return pa.record_batch([pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                   names=["doc_id", *_FIELDS])

        kind = pa.int64()
        for batch in rebatched(batches, 200):
            kind = batch["doc_id"].type
            waiting = []
            for key, prompt_ids, ids in zip(batch["doc_id"].to_pylist(), batch["prompt"].to_pylist(), words.rows(batch["text"])):
                waiting.append((key, ids, prompt_ids))
                if len(ids) > WAITING:
                    packer.add(waiting)
                    waiting = []
                    yield out(packer.run(False))
            packer.add(waiting)
            if packer.waiting >= WAITING:
                yield out(packer.run(False))
        yield out(packer.run(True))

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECES}")
