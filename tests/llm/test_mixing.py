"""Source mixing against a plain reading in exact fractions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction
from math import floor

from starloom.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, start int, at int, target int"


def some_rows():
    rng = random.Random(11)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), f"s{min(int(rng.expovariate(0.5)), 6)}") for i in range(300)]
    rows += [(None, "a b c", "s0"), (None, "a b c", "s0"), (None, None, None), (7, "x\n\ty", None), (7, "x\n\ty", None), (901, None, "s1"), (902, "", "empty"),
             (903, "v " * 20000, "s2"), (904, " \n", None), (905, "é", "Z")]
    return [(*r, "x", 1, 2, 3) for r in rows]


def plain_targets(sizes, weights, share, repeats):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()) * Fraction(share), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > repeats * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in free}
        for s in above:
            target[s] = Fraction(repeats * sizes[s])
            left -= target[s]
        free -= above
    return target


def plain_mix(rows, share=1.5, repeats=2, weights=(3, 1, 2)):
    sizes = defaultdict(int)
    queues = defaultdict(list)
    for row in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
        sizes[row[2]] += n
        key = hashlib.md5(("mix" + ("" if row[0] is None else str(row[0]))).encode()).hexdigest()
        queues[row[2]].append((key, row[0] is not None, row[0] or 0, n))
    target = plain_targets(sizes, weights, share, repeats)
    out = []
    for source, queue in queues.items():
        at, limit = 0, floor(target[source])
        for _, known, doc_id, n in sorted(queue):
            taken = sum(max(0, min(at + k * sizes[source] + n, limit) - (at + k * sizes[source])) for k in range(repeats))
            out.append((doc_id if known else None, n, sizes[source], round(float(target[source]), 6), taken))
            at += n
    return sorted(out, key=repr)


def found_rows(frame):
    return sorted([(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in frame.collect()], key=repr)


def test_mix_equals_plain_reading(spark):
    rows = some_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.digest(mixing.mix(docs.repartition(7)))
    assert found_rows(found) == plain_mix(rows)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, mixing.digest(mixing.mix(docs.repartition(3))).collect()), key=repr)
    few = mixing.digest(mixing.mix(docs, mixing.cycled(5, 1), share=0.25, repeats=1))
    assert found_rows(few) == plain_mix(rows, 0.25, 1, (5, 1))


def test_schedule_is_gapless_and_fair(spark):
    docs = spark.createDataFrame(some_rows(), SCHEMA)
    mixed = mixing.mix(docs)
    rows = mixed.schedule.join(mixed.documents, "doc").orderBy("mix_start").collect()
    at, sent = 0, defaultdict(int)
    for r in rows:
        assert r.mix_start == at and 0 < r.taken <= r["size"]
        at += r.taken
        sent[r.source] += r.taken
        # what a source has sent at a finish time is that share of its target, as no other offer of it ended later
        assert abs(sent[r.source] - r.finish * r.target) < 1e-6 * r.target
    assert [r.finish for r in rows] == sorted(r.finish for r in rows)
    total = sum(r["size"] for r in mixed.documents.collect())
    assert total * 1.5 - len(sent) <= at <= total * 1.5


def test_running_sums_cross_blocks_and_split_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BITS", 3)
    values = [5] * 400 + list(range(200))
    df = spark.createDataFrame([(v, v * 2) for v in values], "v int, n int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else a table this small is one partition
    found = mixing.running(mixing.Scratch(spark, "test"), df, [mixing.F.col("v")], before="n").orderBy("at").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = 0
    for row, value in zip(found, sorted(values), strict=True):
        assert (row.v, row.before) == (value, expected)
        expected += value * 2
    assert len({r["at"] >> 33 for r in found if r.v == 5}) > 1


def test_nothing_to_mix(spark):
    assert mixing.digest(mixing.mix(spark.createDataFrame([], SCHEMA))).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id bigint, text string, source string")
    assert [(r["size"], r.target, r.taken, r.first_at) for r in mixing.digest(mixing.mix(blank)).collect()] == [(0, 0.0, 0, None)] * 2
