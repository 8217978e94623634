"""Words and word hashes of whole Arrow text columns, by numpy passes over their bytes.

A batch is cut into chunks of a few hundred kilobytes of text (a longer text is
a chunk of its own), so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 400_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: One random value per byte, the same in every process.
_BYTE_VALUE = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def space_separated() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    word = np.ones(256, bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return word


def alphanumeric() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (lower-cased text)."""
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x61:0x7B] = word[0x80:] = True
    return word


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ``base`` and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length()) if n > 1 else 1 << 16
        have = tuple(_running_powers(b, size) for b in (base, pow(base, -1, 1 << 64)))
        _powers[base] = have
    return have


def _running_powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, np.uint64)
    out[0] = 1
    done, step = 1, base & _MASK
    while done < size:
        np.multiply(out[:done], np.uint64(step), out=out[done:2 * done])
        step = step * step & _MASK
        done *= 2
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Chunk:
    """Words of rows ``first`` to ``first + rows`` of a batch, in order.

    ``buf`` holds the texts one after the other with a separator between them;
    word ``i`` is ``buf[starts[i]:ends[i]]``, its row's words are
    ``bounds[row]:bounds[row + 1]``.
    """

    first: int
    rows: int
    buf: np.ndarray
    text_at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def row_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        up, down = powers(_BASE, len(self.buf) + 1)
        sums = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[self.buf] * up[:len(self.buf)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def windows(self, hashes: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
        """Hash of the ``k`` words from each word on; only those inside one row mean anything."""
        n = len(hashes)
        out = np.zeros(n, np.uint64)
        if n >= k:
            up, down = powers(base, n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(hashes * up[:n], out=sums[1:])
            out[:n - k + 1] = mix((sums[k:] - sums[:n - k + 1]) * down[:n - k + 1])
        return out

    def room(self) -> np.ndarray:
        """Words from each word to the end of its row, itself included."""
        return np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self.starts))


def chunks(texts: pa.Array, word_byte: np.ndarray, byte_map: np.ndarray | None = None,
           limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cuts a text column into chunks; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    total = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + limit, side="right")))
        part = texts.slice(first, last - first)
        if not isinstance(part, pa.Array):
            part = part.combine_chunks()
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(part)], _whole(part)), pa.scalar("\n", pa.large_string()))
        buf = np.frombuffer(joined[0].as_buffer(), np.uint8)
        if byte_map is not None:
            buf = byte_map[buf]
        inside = np.zeros(len(buf) + 2, np.int8)
        inside[1:-1] = word_byte[buf]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        text_at = np.concatenate([[0], total[first:last] - before])
        yield Chunk(first, last - first, buf, text_at, starts, ends, np.searchsorted(starts, text_at))
        first = last


def _whole(part: pa.Array) -> pa.Array:
    """A slice as an array of its own, which list arrays need."""
    return pa.concat_arrays([part]) if part.offset == 0 else part.take(pa.array(np.arange(len(part))))
