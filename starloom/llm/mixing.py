"""Mixing sources to target weights by weighted fair queueing.

Each source gets a target of words: its weight's share of the budget, at most
``repeats`` times its own size, the excess reshared by weight (the same level
of words per weight for all sources that are not at their limit). A source
offers its documents in a shuffled order, ``repeats`` times over. The virtual
finish time of such an offer is the source's words up to its end, divided by
the source's target, so that every source has sent its target at time 1. All
offers are range-sorted by finish time; what lies beyond the budget is cut,
and a document that is being sent at that moment is taken in part.

Running sums over a global order come from a range sort, sums per block of
rows, and windows inside the blocks, so neither a large source nor the whole
table passes one task. Nothing here leaves Spark's own expressions.

Null texts and texts without words have size 0 and are returned with nothing
taken, and so is everything if no text has a word. Documents without a source
form the last source. Rows with the same id, source and size, wherever they
come from, are told apart by nothing: they share the places in the order that
their id gives them. Very long texts are counted whole. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.tables import Scratch

WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
#: Rows of a block of a running sum, as a power of two.
BLOCK_BITS = 16
WORD = r"[^\x20\x09-\x0D]+"


def cycled(*weights: float) -> Callable[[Column], Column]:
    """Weights by a source's rank (from 0) in code point order, again from the first after the last."""
    values = F.array(*[F.lit(float(w)) for w in weights])
    return lambda rank: F.get(values, (rank % len(weights)).cast("int"))


def running(scratch: Scratch, df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """``df`` with ``at``, which grows with the given order, and for each ``name=column`` the sum of the column over all rows before.

    Rows that are equal in the order are dealt out by their place in the input
    as well, so that a hot value is split.
    """
    keys = [*order, F.col("tie")]
    tied = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = scratch.store(tied.withColumn("at", F.monotonically_increasing_id()).drop("tie"), "running")
    rows = rows.withColumn("block", F.shiftright("at", BLOCK_BITS))
    earlier = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    blocks = rows.groupBy("block").agg(*[F.sum(column).alias(f"{name}_size") for name, column in sums.items()])
    by_block = earlier(Window.orderBy("block"))
    blocks = scratch.store(blocks.select("block", *[before(f"{name}_size", by_block).alias(f"{name}_start") for name in sums]), "blocks")
    inside = earlier(Window.partitionBy("block").orderBy("at"))
    found = rows.join(blocks, "block")
    return found.select(*df.drop("at").columns, "at", *[(F.col(f"{name}_start") + before(column, inside)).alias(name) for name, column in sums.items()])


def sized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``doc_id``, ``source`` and ``size``, the number of words of the text."""
    return docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


@dataclass
class Mix:
    """``documents``: one row each (``doc``, ``doc_id``, ``source``, ``size``, ``source_size``, ``target``).
    ``schedule``: what the mix takes, one row per offer taken (``doc``, ``turn``, ``finish``, ``mix_start``, ``taken``)."""

    documents: DataFrame
    schedule: DataFrame


def targets(scratch: Scratch, sources: DataFrame, weight: Callable[[Column], Column], share: float, repeats: int) -> DataFrame:
    """``source``, ``source_size``, ``source_start`` (words of the sources before it) and ``target``."""
    ranked = running(scratch, sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], rank="one", source_start="source_size")
    weighed = scratch.store(ranked.select(
        "source", "source_size", "source_start", weight(F.col("rank")).alias("weight"), (F.lit(repeats) * F.col("source_size")).alias("most")), "weighed")
    # with sources ordered by words per weight at their limit, the level after the first ones are at theirs is largest where it holds
    full = running(scratch, weighed, [F.col("most") / F.col("weight")], most_before="most", weight_before="weight")
    whole = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, weights = (whole[0] or 0) * share, whole[1] or 0.0
    level = full.agg(F.max((F.lit(budget) - F.col("most_before")) / (F.lit(weights) - F.col("weight_before")))).first()[0]
    target = F.least(F.col("most").cast("double"), F.lit(level or 0.0) * F.col("weight"))
    return scratch.store(weighed.select("source", "source_size", "source_start", target.alias("target")), "targets")


def mix(docs: DataFrame, weight: Callable[[Column], Column] | None = None, share: float = SHARE, repeats: int = REPEATS, seed: str = "mix", **columns: str) -> Mix:
    """Mixes documents so that sources share ``share`` times all words by weight.

    ``weight`` turns a source's rank into its weight; no document is taken more
    than ``repeats`` times. Columns other than the default are given as
    ``id_column``, ``text_column`` and ``source_column``.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.store(sized(docs, **columns), "sized")
    shuffled = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("source").asc_nulls_last(), shuffled, F.col("doc_id").asc_nulls_first(), F.col("size")]
    queued = running(scratch, rows, order, start="size")
    aims = targets(scratch, rows.groupBy("source").agg(F.sum("size").alias("source_size")), weight or cycled(*WEIGHTS), share, repeats)
    aims = aims.withColumnRenamed("source", "aim_source")
    held = queued.join(aims, F.col("source").eqNullSafe(F.col("aim_source")))
    held = scratch.store(held.select(
        F.col("at").alias("doc"), "doc_id", "source", "size", "source_size", "target", (F.col("start") - F.col("source_start")).alias("start")), "queued")
    offers = held.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    begin = F.col("start") + F.col("turn") * F.col("source_size")
    last = F.floor("target")
    offers = offers.withColumn("begin", begin).where(F.col("begin") < last)
    end = F.least(F.col("begin") + F.col("size"), last)
    offers = offers.select("doc", "turn", (end / F.col("target")).alias("finish"), (end - F.col("begin")).alias("taken"))
    sent = running(scratch, offers, [F.col("finish"), F.col("doc"), F.col("turn")], mix_start="taken")
    budget = int((rows.agg(F.sum("size")).first()[0] or 0) * min(share, repeats))
    taken = F.least(F.col("taken"), F.lit(budget) - F.col("mix_start"))
    schedule = sent.where(F.col("mix_start") < budget).select("doc", "turn", "finish", "mix_start", taken.alias("taken"))
    return Mix(held.drop("start"), scratch.store(schedule, "schedule"))


def digest(mixed: Mix) -> DataFrame:
    """One row per document: the words taken, and in ``first_at`` the words of the mix before it first comes."""
    takes = mixed.schedule.groupBy("doc").agg(F.sum("taken").alias("taken"), F.min("mix_start").alias("first_at"))
    return mixed.documents.join(takes, "doc", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_at")


def oracle() -> str:
    """DuckDB SQL for the digest with the default weights, share and repeats."""
    return r"""
WITH rows AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS r FROM sums),
weighed AS (SELECT *, CASE r WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight, 2 * source_size AS most FROM ranked),
levels AS (
  SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM weighed)::DOUBLE - coalesce(sum(most) OVER w, 0)::DOUBLE)
    / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighed WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (SELECT source, source_size, least(most::DOUBLE, (SELECT max(level) FROM levels) * weight) AS target FROM weighed),
queued AS (
  SELECT r.doc_id, r.source, size, source_size, target,
    row_number() OVER o AS doc, coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY md5('mix' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM rows r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source
  WINDOW o AS (ORDER BY r.source NULLS LAST, md5('mix' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size)),
offers AS (
  SELECT doc, turn, target, start + turn * source_size AS begin, least(start + turn * source_size + size, floor(target)) AS finish_at
  FROM queued, (VALUES (0), (1)) t(turn) WHERE size > 0 AND start + turn * source_size < floor(target)),
sent AS (
  SELECT doc, finish_at - begin AS taken,
    coalesce(sum(finish_at - begin) OVER (ORDER BY finish_at / target, doc, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mix_start FROM offers),
takes AS (SELECT doc, sum(taken)::BIGINT AS taken, min(mix_start)::BIGINT AS first_at FROM sent GROUP BY doc)
SELECT doc_id, size::BIGINT AS size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_at FROM queued LEFT JOIN takes USING (doc)
"""
