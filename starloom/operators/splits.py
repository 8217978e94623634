"""Train/test splits and samples with exact, reproducible cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.session import materialize

BIG_GROUP = 100_000


def ranked_within(df: DataFrame, group: str, order: list[Column], bucket: Column, big_group: int = BIG_GROUP) -> DataFrame:
    """Adds ``n`` (group size) and ``pos`` (rank within the group).

    Groups above ``big_group`` rows are ranked in buckets: ``bucket`` must not
    decrease along ``order``, so a row's rank is the number of rows in earlier
    buckets plus its rank inside its own. No task sorts a hot group whole; the
    sizes are stored, as Spark splits a hot key of a join with a stored table
    but not of one with a sum over the same key.
    """
    sizes = materialize(df.groupBy(group).agg(F.count("*").alias("n")), "sizes")
    sized = df.join(sizes, group).withColumn("_bucket", F.when(F.col("n") > big_group, bucket.cast("string")).otherwise(""))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sized.where(F.col("n") > big_group)
        .groupBy(group, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .select(group, "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    cell = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (
        sized.repartition(group, "_bucket")
        .withColumn("_rank", F.row_number().over(cell))
        .join(offsets, [group, "_bucket"], "left")
        .withColumn("pos", F.col("_rank") + F.coalesce("_before", F.lit(0)))
        .drop("_bucket", "_rank", "_before")
    )


def pair_hash() -> Column:
    return F.md5(F.concat_ws("_", "user_id", "item_id"))


def stratified_split(ratings: DataFrame, test_size: float = 0.2, big_group: int = BIG_GROUP) -> DataFrame:
    """``is_test`` for the first ``ceil(test_size * n)`` hashed rows of each user."""
    key = pair_hash()
    ranked = ranked_within(ratings, "user_id", [key, F.col("item_id")], F.substr(key, F.lit(1), F.lit(2)), big_group)
    return ranked.withColumn("is_test", F.col("pos") <= F.ceil(F.col("n") * F.lit(test_size))).drop("n", "pos")


def user_time_split(ratings: DataFrame, test_ratio: float = 0.2, min_ratings: int = 5, big_group: int = BIG_GROUP) -> DataFrame:
    """``is_test`` for each user's latest ratings; short histories stay in train."""
    order = [F.col("ts"), F.col("item_id")]
    ranked = ranked_within(ratings, "user_id", order, F.date_format("ts", "yyyy-MM-dd"), big_group)
    held = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(test_ratio)))
    is_test = (F.col("n") >= min_ratings) & (F.col("pos") > F.col("n") - held)
    return ranked.withColumn("is_test", is_test).drop("n", "pos")


def temporal_split(ratings: DataFrame, test_ratio: float = 0.2, user_ranges: int = 4096) -> DataFrame:
    """``is_test`` for all but the first ``int(n * (1 - test_ratio))`` rows by time.

    The cut is found from counts: the day that holds it, the second within
    that day, the range of user ids within that second. Only the rows of that
    last cell are ranked. One small row per level reaches the driver.
    """
    remaining = int(ratings.count() * (1 - test_ratio))
    low, high = ratings.agg(F.min("user_id"), F.max("user_id")).first()
    width = (high - low) // user_ranges + 1
    levels = [
        F.date_trunc("day", F.col("ts").cast("timestamp")),
        F.date_trunc("second", F.col("ts").cast("timestamp")),
        F.floor((F.col("user_id") - low) / width),
    ]
    cell, before_cut, after_cut = ratings, F.lit(False), F.lit(False)
    equal = F.lit(True)
    for level in levels:
        counts = cell.groupBy(level.alias("level")).agg(F.count("*").alias("rows"))
        running = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
        cut = (
            counts.withColumn("upto", F.sum("rows").over(running))
            .where(F.col("upto") >= remaining)
            .orderBy("level")
            .first()
        )
        if cut is None:
            break
        before_cut = before_cut | (equal & (level < F.lit(cut["level"])))
        after_cut = after_cut | (equal & (level > F.lit(cut["level"])))
        equal = equal & (level == F.lit(cut["level"]))
        remaining -= cut["upto"] - cut["rows"]
        cell = ratings.where(equal)
    clear = ratings.where(before_cut | after_cut).withColumn("is_test", after_cut)
    inside = Window.orderBy("ts", "user_id", "item_id")
    last = cell.withColumn("is_test", F.row_number().over(inside) > remaining)
    return clear.unionByName(last)


def sample_rows(ratings: DataFrame, n: int) -> DataFrame:
    """``n`` rows in hash order: the same rows on every run and engine."""
    return ratings.orderBy(pair_hash(), "user_id", "item_id").limit(n)


def train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")


def cold_start(train: DataFrame, test: DataFrame) -> DataFrame:
    """Users and items that occur in test only."""
    parts = []
    for column in ("user_id", "item_id"):
        only = test.select(column).distinct().join(train.select(column), column, "left_anti")
        parts.append(only.select(F.lit(column).alias("kind"), F.col(column).alias("id")))
    return parts[0].unionByName(parts[1])
