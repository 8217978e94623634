"""Canonical ratings, items and sessions derived from the warehouse tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions import titles

#: Order lines of a task that groups them by user and item.
TASK_LINES = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (user, item): the mean of repeated ratings, the latest time."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), (F.col("l_partkey") + 1).alias("item_id"), "l_quantity", "o_orderdate"
    )
    # a task holds all its pairs, here and where distinct users are counted
    return dealt(joined, lines, "user_id", "item_id").groupBy("user_id", "item_id").agg(
        F.avg(1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("rating"),
        F.max("o_orderdate").alias("ts"),
    )


def dealt(joined: DataFrame, lines: DataFrame, *keys: str) -> DataFrame:
    """Order lines with joined columns, dealt by ``keys`` to more tasks if there are many.

    The number of lines is read from the file footers.
    """
    tasks = math.ceil(lines.count() / TASK_LINES)
    if tasks <= int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return joined
    return joined.repartition(tasks, *keys)


def raw_items(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, folder, "part").select(
        (F.col("p_partkey") + 1).alias("item_id"),
        F.concat(name, F.lit(" ("), (1950 + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.replace(name, F.lit(" "), F.lit("|"))).alias("genres_text"),
    )


def clean_items(raw: DataFrame) -> DataFrame:
    """Adds year, clean title, genre array and HTML-safe title to raw titles."""
    title = F.col("title")
    clean = titles.clean_title(title)
    return raw.select(
        "item_id",
        "title",
        "genres_text",
        titles.release_year(title).alias("year"),
        clean.alias("clean_title"),
        titles.genre_list(F.col("genres_text")).alias("genres"),
        titles.web_title(clean).alias("web_title"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return clean_items(raw_items(spark, folder))


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per session event that carries an item and a rating."""
    return session_columns(table(spark, folder, "events"))


def session_columns(events: DataFrame) -> DataFrame:
    """Item and rating of raw events, in batch or in a stream."""
    return events.select(
        "event_id",
        F.col("user_id").alias("session_id"),
        "ts",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        (1 + F.least(F.lit(4), F.floor(F.col("value") / 20))).cast("double").alias("rating"),
    )


def latest_session_ratings(events: DataFrame) -> DataFrame:
    """The last rating per (session, item): new ratings override old ones."""
    return events.groupBy("session_id", "item_id").agg(
        F.max_by("rating", F.struct("ts", "event_id")).alias("rating"),
        F.max("ts").alias("ts"),
    )
