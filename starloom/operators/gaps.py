"""The first catalogue ids that a user has nothing to do with, without a users x items table.

The catalogue is numbered in id order. Among a user's taken places, a place
``p`` that has ``r`` taken ones before it has ``p - r`` free ones before it, so
the j-th free place is ``j`` plus the number of taken places with at most ``j``
free ones before them. Taken places are counted per stretch of the catalogue
first, and only stretches that begin before the n-th free place are looked at
one by one: neither the whole catalogue nor a user's whole history is walked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starloom.session import materialize

#: Catalogue places of a stretch.
STRETCH = 1024
_PART_BITS = 33


def places(ids: DataFrame) -> DataFrame:
    """``(item_id, place)``: distinct ids numbered from 0 in their order, each range of ids in its own task."""
    rows = ids.select("item_id").where("item_id IS NOT NULL").distinct().repartitionByRange("item_id").sortWithinPartitions("item_id")
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "places")
    rows = rows.withColumn("part", F.shiftright("at", _PART_BITS))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    before = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return rows.join(before, "part").select("item_id", (F.col("before") + F.col("at") - F.shiftleft("part", _PART_BITS)).alias("place"))


def first_missing(users: DataFrame, taken: DataFrame, catalogue: DataFrame, n: int, stretch: int = STRETCH) -> DataFrame:
    """``(user_id, item_id)``: for each of ``users`` the ``n`` smallest catalogue ids that are not among its ``taken(user_id, item_id)`` rows."""
    numbered = materialize(places(catalogue), "catalogue")
    rows = taken.select("user_id", "item_id").distinct().join(numbered, "item_id").select(
        "user_id", "place", F.floor(F.col("place") / stretch).alias("stretch"))
    rows = materialize(rows, "taken")
    counts = rows.groupBy("user_id", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("user_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    heads = counts.select("user_id", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    heads = heads.where(F.col("stretch") * stretch - F.col("before") < n)
    inside = Window.partitionBy("user_id", "stretch").orderBy("place")
    free_before = F.col("place") - F.col("before") - (F.row_number().over(inside) - 1)
    walked = rows.join(heads, ["user_id", "stretch"]).select("user_id", free_before.alias("free")).where(F.col("free") < n)
    steps = walked.groupBy("user_id", "free").agg(F.count("*").alias("n"))  # at most n rows per user
    steps = steps.groupBy("user_id").agg(F.collect_list(F.struct("free", "n")).alias("steps"))
    passed = F.aggregate(F.filter("steps", lambda s: s["free"] <= F.col("j")), F.lit(0).cast("long"), lambda total, s: total + s["n"])
    wanted = users.select("user_id").distinct().join(steps, "user_id", "left").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    wanted = wanted.select("user_id", (F.col("j") + F.coalesce(passed, F.lit(0))).alias("place"))
    return wanted.join(numbered, "place").select("user_id", "item_id")
