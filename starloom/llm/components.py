"""Connected components of an edge table by alternating star contractions.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014):
each round points neighbours to the smallest id they know. Every step is a
grouped minimum and a join on a node, so a hub is a skewed join key, not a
collected group. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import Scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every node that is not the smallest of its component.

    Null ends are ignored, as are loops and repeated edges.
    """
    scratch = Scratch(edges.sparkSession, label)
    now = scratch.store(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    state = _state(now)
    while state[0]:
        last, now = now, scratch.store(_small_star(_large_star(now)), "round")
        scratch.drop(last)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
