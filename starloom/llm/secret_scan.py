"""Secret scans: fixed patterns, and a sliding-window entropy per character class.

Candidate strings are runs of key-like characters. Inside each, runs of one
character class are scanned with a window whose Shannon entropy is kept up to
date by its character counts: one character enters, one leaves. Windows above
the class's threshold are joined to spans; what earlier spans hold already is
cut out of them. Placeholders are cut out of a candidate before, and an
allow-list drops what is left if all of it has a known harmless form. Spans of
the fixed patterns are never dropped.

Null and empty texts have no spans; the time for a long text grows with its
length, whatever its characters. Repeated rows each get their own result;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import id_text, rebatched

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class CharClass:
    """A window of ``width`` characters of ``pattern`` counts from ``bits`` of entropy on."""

    kind: str
    pattern: str
    width: int
    bits: float


CLASSES = (
    CharClass("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.9),
    CharClass("entropy_hex", r"[0-9A-Fa-f]{20,}", 20, 3.1),
)
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
#: Parts of sample keys and alphabets: no window reaches into them, the rest of the string is scanned.
PLACEHOLDER = re.compile(r"abcdefghij|0123456789|qwertyuiop|example|x{6,}", re.IGNORECASE | re.ASCII)
#: Strings that look random but are none: ids in canonical form, paths and slugs of plain words, dates.
ALLOW = (
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"[A-Za-z/_=-]*[0-9]{0,8}",
    r"[0-9/_=-]+",
)


def window_entropy_spans(text: str, width: int, bits: float) -> list[tuple[int, int]]:
    """Unions of the windows of ``width`` characters with at least ``bits`` of entropy."""
    if len(text) < width:
        return []
    term = [0.0, 0.0, *(c * log2(c) for c in range(2, width + 1))]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    most = (log2(width) - bits) * width + 1e-9  # entropy = log2(width) - total / width
    for end, char in enumerate(text, 1):
        if end > width:  # one leaves before the next enters, so no count exceeds the width
            gone = text[end - width - 1]
            c = counts[gone]
            counts[gone] = c - 1
            total += term[c - 1] - term[c]
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += term[c + 1] - term[c]
        if end >= width and total <= most:
            if spans and end - width <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((end - width, end))
    return spans


def pieces(start: int, end: int, gaps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the ``gaps`` leave of the range from ``start`` to ``end``."""
    out = []
    for a, b in sorted(gaps):
        if a >= end:
            break
        if a > start:
            out.append((start, a))
        start = max(start, b)
    return [*out, (start, end)] if start < end else out


class Scanner:
    """Finds the spans ``(kind, start, end)`` of one text."""

    def __init__(self, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW):
        self.classes = [(c, re.compile(c.pattern)) for c in classes]
        self.allow = [re.compile(p) for p in allow]
        order = {kind: i for i, kind in enumerate(["assign", "access", "hex", *(c.kind for c in classes)])}
        self.key = lambda s: (s[1], order[s[0]], s[2])

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        taken = [(s, e) for _, s, e in found]
        for m in CANDIDATE.finditer(text):
            if self.allowed(m[0]):
                continue
            for low, high in pieces(m.start(), m.end(), [p.span() for p in PLACEHOLDER.finditer(text, *m.span())]):
                if self.allowed(text[low:high]):
                    continue
                for c, pattern in self.classes:
                    for run in pattern.finditer(text, low, high):
                        if not DIGIT.search(run[0]) or run[0].isdigit():
                            continue
                        for s, e in window_entropy_spans(run[0], c.width, c.bits):
                            rest = pieces(run.start() + s, run.start() + e, taken)
                            found += [(c.kind, *span) for span in rest]
                            taken += rest
        return sorted(found, key=self.key)

    def allowed(self, word: str) -> bool:
        return not DIGIT.search(word) or any(p.fullmatch(word) for p in self.allow)

    def masked(self, text: str, mask: str) -> str:
        """``text`` with every found span replaced; overlapping spans get one mask."""
        out, at = [], 0
        for _, start, end in self.spans(text):
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, end)
        return "".join([*out, text[at:]]) if at else text


SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``doc_id`` and its spans (code points, end exclusive) by start, then kind."""
    docs = id_text(docs, id_column, text_column)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allow)
        for batch in rebatched(batches):
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in scanner.spans(t.as_py())] for t in batch["text"]]
            yield pa.record_batch({"doc_id": batch["doc_id"], "spans": pa.array(spans, _SPAN_ARROW)})

    return docs.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPAN}")


def mask_secrets(docs: DataFrame, text_column: str = "text", mask: str = "[secret]",
                 classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """All columns of ``docs``, secrets in the text replaced by ``mask``; null stays null."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allow)
        for batch in rebatched(batches):
            at = batch.schema.get_field_index(text_column)
            texts = [t if t is None else scanner.masked(t, mask) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(scan, docs.schema)


def joined(spans) -> F.Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_secrets``."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
