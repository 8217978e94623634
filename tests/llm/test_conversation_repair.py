"""Conversation repair against a plain reading: damage row by row, and the best of all repairs by a table of whole strings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from starloom.llm import conversation_repair as repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, at int, fault string, edits string, block int"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out[conv] += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {conv: sorted(turns) for conv, turns in out.items()}


def plain_faults(turns):
    seen, faults = set(), []
    for _, _, role, text in turns:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def plain_repair(turns, faults):
    """Best (cost, audit, output) by the output's shape so far: every prefix of the grammar is one of four shapes."""
    shape = lambda initials: "" if not initials else "s" if initials == "s" else initials[-1]
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for before, (cost, audit, made) in list(best.items()):
                for role in ("user", "assistant"):
                    item = (cost + 2, audit + "I", (*made, (role, "")))
                    if (before, role[0]) in legal and (role[0] not in best or item < best[role[0]]):
                        best[role[0]] = item
        return best

    for (_, _, role, text), fault in zip(turns, faults):
        after = {}
        for before, (cost, audit, made) in inserted(best).items():
            moves = [(before, (cost + 3, audit + "D", made))]
            if fault not in ("blank", "duplicate"):
                extra = cost + (fault == "truncated")
                moves += [(role[:1], (extra, audit + "K", (*made, (role, text))))] * ((before, role[:1]) in legal)
                moves += [(new[0], (extra + 2, audit + "R", (*made, (new, text)))) for new in ("user", "assistant") if (before, new[0]) in legal]
            for to, item in moves:
                if to not in after or item[:2] < after[to][:2]:
                    after[to] = item
        best = after
    cost, audit, made = min((best[s] for s in ("", "a") if s in inserted(best)), key=lambda i: i[:2])
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in made)


def plain_digest(rows):
    out = []
    for conv, turns in plain_damage(rows).items():
        faults = plain_faults(turns)
        cost, audit, text = plain_repair(turns, faults)
        numbers = {t for known, t, _, _ in turns if known}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_rows(conversations=60, longest=14, seed=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system"] if not turn else ["user", "assistant"] if rng.random() < 0.3 else ["assistant" if turn % 2 else "user"])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, rng.choice(["Yes.", "No!", "cut of", " \t", "Well?", "é.\n ", f"Text {rng.random()}."])))
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (500, None, "tool", "x"), (500, None, "user", "y."), (501, 0, "", "z."), (502, 0, "ugly", "w." * 20000)]
    rows += [(503, 1, "user", "Same.")] * 5 + [(504, 0, "assistant", None), (504, 1, None, "Hm.")]
    return [(*r, 1, "f", "e", 2) for r in rows]


def found_rows(spark, rows, parts=4):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, repair.digest(repair.repair(repair.damaged(frame))).collect()), key=repr)


def test_digest_equals_plain_reading(spark):
    rows = some_rows()
    assert found_rows(spark, rows) == plain_digest(rows)


@pytest.mark.parametrize("bits", [0, 2])
def test_parts_compose_to_the_same_repair(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = some_rows(20, 40, seed=bits + 9)
    assert found_rows(spark, rows, 7) == plain_digest(rows)


def test_one_long_conversation(spark):
    rng = random.Random(2)
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", rng.choice(["Same.", f"Own {t}.", "open"]), 1, "f", "e", 2) for t in range(4000)]
    assert found_rows(spark, rows) == plain_digest(rows)


def every_audit(turns):
    """All audits of few turns with at most two insertions in a row, by trying them."""
    choices = []
    for initial, fault in turns:
        own = [("D", None, 3)]
        if fault != "d":
            own += [("K", initial, fault == "t"), ("R", "u", 2 + (fault == "t")), ("R", "a", 2 + (fault == "t"))]
        choices.append(own)
    gaps = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]
    for picked in itertools.product(*choices):
        for inserted in itertools.product(gaps, repeat=len(turns) + 1):
            audit, initials, cost = "", "", 0
            for k, (edit, initial, more) in enumerate([*picked, ("", None, 0)]):
                audit += "I" * len(inserted[k]) + edit
                initials += "".join(inserted[k]) + (initial or "")
                cost += 2 * len(inserted[k]) + more
            if GRAMMAR.match(initials):
                yield cost, audit


def test_agenda_finds_the_lightest_of_all_repairs():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3, 3, 3):
        turns = [(rng.choice("suat"), rng.choice(["", "", "t", "d"])) for _ in range(n)]
        assert min(repair.lightest(turns, repair.START, repair.ACCEPTED).values()) == min(every_audit(turns)), turns


def test_repaired_turns_are_well_formed(spark):
    frame = spark.createDataFrame(some_rows(), SCHEMA)
    rows = defaultdict(str)
    for r in repair.repaired(repair.repair(repair.turns_of(frame))).orderBy("conv_id", "at", "pos").collect():
        rows[r.conv_id] += r.role[:1]
    assert rows and all(GRAMMAR.match(initials) for initials in rows.values())
    assert repair.digest(repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA)))).count() == 0
