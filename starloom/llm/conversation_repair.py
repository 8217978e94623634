"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed if it is empty, or if after an optional system
turn it alternates user and assistant turns, ending with the assistant. Turns
are kept, given another role, or deleted, and empty turns are inserted, at the
least cost; of equally cheap repairs the one whose audit (the initials of its
edits: Keep, Rerole, Delete, Insert) comes first in ASCII order is taken.

Repairs are derived as items ``(turns consumed, state)`` of a weighted
hypergraph: an item and an edit yield the next item, with the cost added and
the edit's initial appended to the audit. That function grows in both, so items
taken from the agenda by (cost, audit) are final, and the first goal item taken
is the lightest derivation.

Turns are range-sorted by conversation and order in one shuffle and numbered;
blocks of consecutive turns are repaired in parallel. Conversations inside one
block are finished there. For a part of a longer one the agenda runs from each
state to each state, and the parts are composed in order, so that of a very
long conversation only one character per turn meets in one task, never its
texts.

Defined cases: a null role or text is one space, and a null id or turn is one
space where the damage is drawn. Null turns come first; turns with the same
number come by role, then text. Rows without an id form one conversation. A
turn without a text but white space is blank, one with the role and text of an
earlier turn of its conversation a duplicate, one whose last visible character
ends no sentence truncated; the first that fits counts. Repeated rows are
duplicates. Very long texts are read whole. Other columns are ignored. Empty
tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import Scratch, rebatched

#: Turns of a block, as a power of two.
BLOCK_BITS = 10
#: States of the grammar: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ACCEPTED = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1


def next_role(state: int) -> str:
    """The initial of the role that a rerole or insertion can only give in a state."""
    return "a" if state == USER else "u"


def lightest(turns: list[tuple[str, str]], entry: int, goals: tuple[int, ...], every: bool = False) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) from ``entry`` through all ``turns`` to a goal state, or to ``every`` goal state.

    A turn is its role's initial and its fault: "" for none, "t" for truncated,
    "d" if it must be deleted.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, at, state = heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if at == len(turns) and state in goals:
            found[state] = (cost, audit)
            if not every or len(found) == len(goals):
                break
        after = STEPS[state, next_role(state)]
        edges = [(INSERT, "I", at, after)]
        if at < len(turns):
            initial, fault = turns[at]
            edges.append((DELETE, "D", at + 1, state))
            if fault != "d":
                extra = TRUNCATED if fault else 0
                edges.append((REROLE + extra, "R", at + 1, after))
                if (state, initial) in STEPS:
                    edges.append((extra, "K", at + 1, STEPS[state, initial]))
        for more, edit, to, then in edges:
            if (to, then) not in final:
                heappush(agenda, (cost + more, audit + edit, to, then))
    return found


class Composition:
    """Composes the parts of one conversation in order, each given as ``(entry, exit, cost, audit)`` items.

    An item is its cost, its audit after what all items share, and for each part
    its entry state and the length of its audit there.
    """

    def __init__(self):
        self.items: dict[int, tuple[int, str, tuple]] = {START: (0, "", ())}
        self.settled: list[str] = []

    def add(self, part: list[tuple[int, int, int, str]]) -> None:
        after: dict[int, tuple[int, str, tuple]] = {}
        for entry, exit, cost, audit in part:
            if entry in self.items:
                before = self.items[entry]
                item = (before[0] + cost, before[1] + audit, (*before[2], (entry, len(audit))))
                if exit not in after or item < after[exit]:
                    after[exit] = item
        if ASSISTANT in after:  # whatever follows an item that is dearer by more than this follows the assistant's cheaper
            bound = {START: after[ASSISTANT][0] + DELETE, SYSTEM: after[ASSISTANT][0]}
            after = {state: item for state, item in after.items() if item[0] <= bound.get(state, item[0])}
        low, high = min(i[1] for i in after.values()), max(i[1] for i in after.values())
        same = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        self.settled.append(low[:same])
        self.items = {state: (cost, audit[same:], path) for state, (cost, audit, path) in after.items()}

    def done(self) -> tuple[int, str, tuple]:
        cost, audit, path = min(self.items[s] for s in ACCEPTED if s in self.items)
        return cost, "".join(self.settled) + audit, path


def per_turn(audit: str, turns: int) -> Iterator[str]:
    """The edits of each turn, with the insertions before it; those after the last turn of a part belong to the last."""
    at = 0
    for k in range(turns):
        end = at
        while audit[end] == "I":
            end += 1
        end = end + 1 if k < turns - 1 else len(audit)
        yield audit[at:end]
        at = end


def damaged(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """Turns with faults planted by a hash of id and turn; ``dropped`` ones are still rows, but no turns."""
    space = F.lit(" ")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(text_of(id_column), F.lit(":"), text_of(turn_column))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text_of(text_column), ".!?", "")).when(kind == 0, "").otherwise(text_of(text_column))
    return conversations.select(
        F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"), F.when(kind == 4, "user").otherwise(text_of(role_column)).alias("role"),
        text.alias("text"), (kind == 0).alias("dropped"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def turns_of(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """Turns as they are, in the columns that :func:`repair` takes."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(F.col(id_column).alias("conv_id"), F.col(turn_column).alias("turn"), text_of(role_column).alias("role"),
                                text_of(text_column).alias("text"), F.lit(False).alias("dropped"))


def ordered_turns(scratch: Scratch, turns: DataFrame) -> DataFrame:
    """All turns with ``at``, which grows with conversation and order, their fault but for duplicates, and ``same``, equal for equal turns."""
    visible = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(visible == "", "blank").when(visible.isin(".", "!", "?"), "").otherwise("truncated")
    own = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.length("role"), F.lit(":"), "role", "text")
    rows = turns.withColumns({"fault": fault, "same": F.unhex(F.sha2(own, 256)), "tie": F.monotonically_increasing_id()})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 256), F.col("same"), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.store(rows.drop("tie").withColumn("at", F.monotonically_increasing_id()), "ordered")


def with_faults(scratch: Scratch, ordered: DataFrame) -> DataFrame:
    """``conv_id``, ``at``, role ``initial`` and ``fault`` (one character each) of all turns, without their texts."""
    live = ordered.where("NOT dropped").select("conv_id", "at", "same", "fault", F.substring("role", 1, 1).alias("initial"))
    firsts = live.where("fault <> 'blank'").groupBy("same").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = scratch.store(firsts, "firsts")  # a table of its own, so that Spark can split the join at a hot text
    again = (F.col("fault") != "blank") & (F.col("at") > F.col("first_at"))
    return live.join(firsts, "same", "left").select(
        "conv_id", "at", F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-").alias("initial"),
        F.when(again, "d").when(F.col("fault") == "", "-").otherwise(F.substring("fault", 1, 1)).alias("fault"))


def _same(a, b) -> bool:
    return a == b or (a is None and b is None)


def _runs(rows: Iterator[dict], key: str) -> Iterator[list[dict]]:
    """Consecutive rows with one value of ``key``."""
    held: list[dict] = []
    for row in rows:
        if held and not _same(held[0][key], row[key]):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for part in rebatched(iter([batch]), 1000):
            yield from part.to_pylist()


def _tables(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _turns(initials: str, faults: str) -> list[tuple[str, str]]:
    return [(i, {"-": "", "t": "t"}.get(f, "d")) for i, f in zip(initials, faults)]


def _exits(entry: int) -> tuple[int, ...]:
    return {START: STATES, SYSTEM: (SYSTEM, USER, ASSISTANT)}.get(entry, (USER, ASSISTANT))


def _parts(rows: Iterator[dict]) -> Iterator[dict]:
    """The part of a conversation that a block holds, with its lightest repairs."""
    for block in _runs(rows, "block"):
        runs = list(_runs(iter(block), "conv_id"))
        for k, run in enumerate(runs):
            initials, faults = ("".join(r[c] for r in run) for c in ("initial", "fault"))
            turns = _turns(initials, faults)
            whole = 0 < k < len(runs) - 1
            if whole:
                items = [(START, *i) for i in lightest(turns, START, ACCEPTED).items()]
            else:
                items = [(entry, *i) for entry in STATES for i in lightest(turns, entry, _exits(entry), every=True).items()]
            yield {"conv_id": run[0]["conv_id"], "part": run[0]["at"], "ats": [r["at"] for r in run], "initials": initials, "faults": faults,
                   "whole": whole, "items": [{"entry": entry, "exit": exit, "cost": cost, "audit": audit} for entry, exit, (cost, audit) in items]}


def _composed(rows: Iterator[dict]) -> Iterator[dict]:
    """The chosen repair of each part of a conversation, whose rows come in order."""
    key, places, held = None, [], Composition()

    def finished() -> Iterator[dict]:
        cost, audit, path = held.done()
        at = 0
        for k, (place, (state, length)) in enumerate(zip(places, path)):
            yield {"part": place, "state": state, "cost": 0 if k else cost, "audit": audit[at:at + length]}
            at += length

    for row in rows:
        if places and not _same(row["conv_id"], key):
            yield from finished()
            places, held = [], Composition()
        key = row["conv_id"]
        places.append(row["part"])
        held.add([tuple(i[c] for c in ("entry", "exit", "cost", "audit")) for i in row["items"]])
    if places:
        yield from finished()


def _edits(rows: Iterator[dict]) -> Iterator[dict]:
    """The edits of each turn of a repaired part, and the role that each gives."""
    for row in rows:
        state = row["state"]
        for k, (at, initial, fault, audit) in enumerate(zip(row["ats"], row["initials"], row["faults"], per_turn(row["audit"], len(row["ats"])))):
            edits = []
            for edit in audit:
                role = ROLES[next_role(state)] if edit in "IR" else None
                if edit != "D":
                    state = STEPS[state, initial if edit == "K" else next_role(state)]
                edits.append({"edit": edit, "role": role})
            yield {"at": at, "found": FAULTS[fault], "edits": edits, "cost": 0 if k else row["cost"]}


FAULTS = {"-": None, "b": "blank", "d": "duplicate", "t": "truncated"}
_ITEM = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_EDIT = pa.struct([("edit", pa.string()), ("role", pa.string())])
_CHOSEN = pa.schema([("part", pa.int64()), ("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_EDITED = pa.schema([("at", pa.int64()), ("found", pa.string()), ("edits", pa.list_(_EDIT)), ("cost", pa.int64())])
CHOSEN = "part long, state int, cost long, audit string"
EDITED = "at long, found string, edits array<struct<edit:string,role:string>>, cost long"


def repair(turns: DataFrame) -> DataFrame:
    """The turns of :func:`damaged` or :func:`turns_of` with what is wrong with them and how they are repaired.

    Columns: ``conv_id``, ``at`` (grows along each conversation), ``turn``,
    ``role``, ``text``, ``dropped``, ``fault`` (null if none), ``edits`` (an array
    of ``edit`` and the ``role`` that it gives: insertions before the turn, then
    the turn's own edit, then insertions at the end of the conversation) and
    ``cost`` (of the conversation, on its first turn, else 0).
    """
    scratch = Scratch(turns.sparkSession, "conversation_repair")
    ordered = ordered_turns(scratch, turns)
    id_field = pa.field("conv_id", _arrow(ordered))
    parts_schema = pa.schema([id_field, ("part", pa.int64()), ("ats", pa.list_(pa.int64())), ("initials", pa.string()), ("faults", pa.string()),
                              ("whole", pa.bool_()), ("items", pa.list_(_ITEM))])
    parts_ddl = (f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, part long, ats array<long>, initials string, faults string, whole boolean, "
                 "items array<struct<entry:int,exit:int,cost:long,audit:string>>")
    blocks = with_faults(scratch, ordered).withColumn("block", F.shiftright("at", BLOCK_BITS))
    blocks = blocks.repartition("block").sortWithinPartitions("block", "at")
    parts = scratch.store(blocks.mapInArrow(lambda b: _tables(_parts(_rows(b)), parts_schema), parts_ddl), "parts")
    open_parts = parts.where("NOT whole").select("conv_id", "part", "items")
    open_parts = open_parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    chosen = open_parts.mapInArrow(lambda b: _tables(_composed(_rows(b)), _CHOSEN), CHOSEN)
    item = F.col("items")[0]
    closed = parts.where("whole").select("ats", "initials", "faults", item["entry"].alias("state"), item["cost"].alias("cost"), item["audit"].alias("audit"))
    composed = parts.where("NOT whole").select("part", "ats", "initials", "faults").join(chosen, "part").drop("part")
    edits = closed.unionByName(composed).mapInArrow(lambda b: _tables(_edits(_rows(b)), _EDITED), EDITED)
    return ordered.drop("same", "fault").join(edits, "at", "left").withColumnRenamed("found", "fault")


def _arrow(ordered: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(ordered.schema["conv_id"].dataType)


def repaired(edited: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``at`` and ``pos`` (the order), ``edit``, ``role``, ``text``."""
    rows = edited.select("conv_id", "at", F.posexplode("edits").alias("pos", "made"), "role", "text").where("made.edit <> 'D'")
    return rows.select("conv_id", "at", "pos", F.col("made.edit").alias("edit"), F.coalesce("made.role", "role").alias("role"),
                       F.when(F.col("made.edit") == "I", "").otherwise(F.col("text")).alias("text"))


def _digests(rows: Iterator[dict]) -> Iterator[dict]:
    """The figures of each conversation, whose rows come in order; no more than one row is held."""
    out: dict = {}
    digest, before, first, audit = None, None, True, []

    def finished() -> dict:
        low, high = out.pop("low"), out.pop("high")
        gaps = high - low + 1 - out.pop("turns") if low is not None else 0
        return out | {"gaps": gaps, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    for row in rows:
        if digest is None or not _same(row["conv_id"], out["conv_id"]):
            if digest is not None:
                yield finished()
            digest, before, first, audit = hashlib.sha256(), None, True, []
            out = {"conv_id": row["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "low": None, "high": None, "turns": 0}
        if row["dropped"]:
            continue
        if row["fault"]:
            out[row["fault"]] += 1
        initial = row["role"][:1]
        out["illegal"] += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        turn = row["turn"]
        if turn is not None and turn != out["high"]:
            out["low"] = turn if out["low"] is None else out["low"]
            out["high"], out["turns"] = turn, out["turns"] + 1
        out["cost"] += row["cost"]
        for made in row["edits"]:
            audit.append(made["edit"])
            if made["edit"] != "D":
                text = "" if made["edit"] == "I" else row["text"]
                digest.update(f"{'' if first else chr(10)}{made['role'] or row['role']}:{text}".encode())
                first = False
    if digest is not None:
        yield finished()


def digest(edited: DataFrame) -> DataFrame:
    """One row per conversation with the contract's figures.

    A SHA-256 is computed in order, so the texts of a conversation pass one
    task, as a sorted stream of which one batch is held.
    """
    id_type = edited.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([pa.field("conv_id", _arrow(edited)), *((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    rows = edited.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    ddl = f"conv_id {id_type}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string"
    return rows.mapInArrow(lambda b: _tables(_digests(_rows(b)), schema), ddl)
