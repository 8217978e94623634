"""Rating statistics, quality summary and data checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.scores import HIGH, LOW, half_even


def item_stats(ratings: DataFrame, digits: int = 3) -> DataFrame:
    """Count, mean, sample deviation and distinct users per item."""
    return ratings.groupBy("item_id").agg(
        F.count("*").alias("rating_count"),
        half_even(F.avg("rating"), digits).alias("avg_rating"),
        half_even(F.stddev_samp("rating"), digits).alias("rating_std"),
        F.countDistinct("user_id").alias("unique_users"),
    )


def feature_stats(ratings: DataFrame) -> DataFrame:
    """Item statistics with the median; the deviation of one rating becomes 0.

    ``median`` keeps one counter per distinct rating value of an item, which
    the rating scale bounds, so a hot item costs no more than a small one. Users
    are counted apart: beside them the counters would be kept per item and user.
    ``ratings`` is read twice.
    """
    stats = ratings.groupBy("item_id").agg(
        half_even(F.avg("rating"), 3).alias("avg_rating"),
        F.count("*").alias("num_ratings"),
        F.coalesce(half_even(F.stddev_samp("rating"), 3), F.lit(0.0)).alias("rating_std"),
        half_even(F.median("rating"), 3).alias("median_rating"),
    )
    pairs = ratings.where("user_id IS NOT NULL").select(F.col("item_id").alias("_item"), "user_id").distinct()
    users = pairs.groupBy("_item").agg(F.count("*").alias("num_users"))
    joined = stats.join(users, F.col("item_id").eqNullSafe(F.col("_item")), "left").drop("_item")
    return joined.withColumn("num_users", F.coalesce("num_users", F.lit(0)))


def approx_users(ratings: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Distinct users per item from a sketch of fixed size."""
    return ratings.groupBy("item_id").agg(F.approx_count_distinct("user_id", rsd).alias("approx_users"))


def with_stats(items: DataFrame, stats: DataFrame) -> DataFrame:
    """Every item with its statistics; unrated items count 0 and keep a null mean."""
    return items.join(stats, "item_id", "left").withColumn("rating_count", F.coalesce("rating_count", F.lit(0)))


def quality_summary(items_with_stats: DataFrame, sufficient: int = 100, high: int = 1000) -> DataFrame:
    """One row of catalogue totals.

    The exact median keeps one counter per distinct rating count; N ratings
    allow at most sqrt(2N) distinct counts.
    """
    n = F.col("rating_count")
    return items_with_stats.agg(
        F.count("*").alias("total_items"),
        F.count_if(n > 0).alias("items_with_ratings"),
        F.count_if(n >= sufficient).alias("items_with_sufficient_ratings"),
        F.count_if(n >= high).alias("items_with_high_ratings"),
        F.avg(n).alias("avg_ratings_per_item"),
        F.median(n).alias("median_ratings_per_item"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value; the total is summed over the few groups."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percentage", 100.0 * F.col("n") / total)


def rating_distribution(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("rating").agg(F.count("*").alias("n"))


def genre_distribution(items: DataFrame) -> DataFrame:
    return items.select(F.explode("genres").alias("genre")).groupBy("genre").agg(F.count("*").alias("n"))


def activity(ratings: DataFrame, column: str) -> DataFrame:
    return ratings.groupBy(column).agg(F.count("*").alias("n"))


def serving_stats(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean and count shown with an item; 3.5 and 0 when nobody rated it."""
    stats = ratings.groupBy("item_id").agg(
        half_even(F.avg("rating"), 1).alias("average_rating"), F.count("*").alias("rating_count")
    )
    return items.join(stats, "item_id", "left").withColumns({
        "average_rating": F.coalesce("average_rating", F.lit(3.5)),
        "rating_count": F.coalesce("rating_count", F.lit(0)),
    })


def sparsity(ratings: DataFrame) -> DataFrame:
    cells = F.countDistinct("user_id") * F.countDistinct("item_id")
    return ratings.agg((1 - F.count("*") / cells).alias("sparsity"))


def means(ratings: DataFrame) -> tuple[Column, DataFrame, DataFrame]:
    """Global mean as a scalar subquery, and the means per user and per item."""
    overall = ratings.agg(F.avg("rating")).scalar()
    users = ratings.groupBy("user_id").agg(F.avg("rating").alias("user_mean"), F.count("*").alias("user_n"))
    items = ratings.groupBy("item_id").agg(F.avg("rating").alias("item_mean"), F.count("*").alias("item_n"))
    return overall, users, items


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one aggregate pass."""
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.corr(a, b).alias("correlation"))
        for a, b in pairs
    ]).alias("cells"))
    return row.select(F.inline("cells"))


def catalogue_summary(items: DataFrame, initial: DataFrame) -> DataFrame:
    """Totals of the served catalogue; a placeholder poster is not a real one."""
    poster = F.col("poster_url")
    return items.agg(
        F.count("*").alias("total_items"),
        F.count_if(poster.isNotNull() & ~F.contains(F.lower(poster), F.lit("placeholder"))).alias("items_with_posters"),
    ).withColumn("initial_items", initial.agg(F.count("*")).scalar()).withColumn(
        "data_loaded", F.col("total_items") > 0
    )


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose key is missing from the dimension."""
    return facts.join(dimension.select(key), key, "left_anti")


def item_violations(items: DataFrame) -> DataFrame:
    """Catalogue rows with the range rules they break."""
    length = F.char_length("clean_title")
    rules = {
        "bad_year": F.coalesce(~F.col("year").between(1900, 2030), F.lit(True)),
        "bad_average": ~F.col("average_rating").between(0.0, 5.0),
        "bad_count": F.col("rating_count") < 0,
        "bad_title": ~length.between(1, 500),
        "no_genre": F.size("genres") == 0,
    }
    return items.select("item_id", *[rule.alias(name) for name, rule in rules.items()])


def rating_request_checks(ratings: DataFrame, key: str, requested: int = 20, required: int = 15) -> DataFrame:
    """Whether each user's ratings form a valid request."""
    bad_id = F.count_if(F.col("item_id") <= 0)
    bad_value = F.count_if(~F.col("rating").between(LOW, HIGH))
    n = F.count("*")
    return ratings.groupBy(key).agg(
        n.alias("n_ratings"),
        bad_id.alias("bad_ids"),
        bad_value.alias("bad_ratings"),
        ((bad_id == 0) & (bad_value == 0) & (n >= required) & F.lit(1 <= requested <= 100)).alias("is_valid"),
    )


def dataset_checks(
    items: DataFrame,
    initial: DataFrame,
    ratings: DataFrame,
    min_items: int,
    min_ratings: int,
    initial_range: tuple[int, int] = (20, 35),
    min_initial_count: int = 500,
    min_initial_genres: int = 6,
    min_genres: int = 10,
    year_span: tuple[int, int] = (1920, 2000),
) -> DataFrame:
    """A ``(check, passed)`` table over catalogue, initial list and ratings."""
    genres_of = lambda df: df.select(F.explode("genres").alias("g"))
    row = items.agg(
        (F.count("*") >= min_items).alias("enough_items"),
        ((F.min("year") <= year_span[0]) & (F.max("year") >= year_span[1])).alias("year_range"),
    )
    first = initial.agg(
        F.count("*").between(*initial_range).alias("initial_size"),
        (F.count_if(F.col("rating_count") < min_initial_count) <= 5).alias("initial_counts"),
    )
    facts = ratings.agg(
        (F.count("*") >= min_ratings).alias("enough_ratings"),
        ((F.min("rating") >= LOW) & (F.max("rating") <= HIGH)).alias("rating_range"),
        (F.count_if(F.col("user_id").isNull() | F.col("item_id").isNull() | F.col("rating").isNull()) == 0).alias("no_nulls"),
    )
    subset = orphans(initial, items, "item_id").agg((F.count("*") == 0).alias("initial_in_catalogue"))
    known = orphans(ratings, items, "item_id").agg((F.count("*") == 0).alias("ratings_in_catalogue"))
    initial_genres = genres_of(initial).agg((F.countDistinct("g") >= min_initial_genres).alias("initial_genres"))
    all_genres = genres_of(items).agg((F.countDistinct("g") >= min_genres).alias("all_genres"))

    def long(df: DataFrame) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("check"), F.col(c).alias("passed")) for c in df.columns]
        return df.select(F.inline(F.array(*cells)))

    parts = [row, first, facts, subset, known, initial_genres, all_genres]
    result = long(parts[0])
    for part in parts[1:]:
        result = result.unionByName(long(part))
    return result
