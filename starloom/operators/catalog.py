"""Catalogue search, selection, genre weights and metadata matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import titles
from starloom.functions.scores import half_even, temporal_weight, top_n


def year_range(items: DataFrame) -> Column:
    """``(first, last)`` year as one scalar subquery, no window over all rows."""
    return items.agg(F.struct(F.min("year").alias("first"), F.max("year").alias("last"))).scalar()


def with_year_features(items: DataFrame) -> DataFrame:
    span = year_range(items)
    first, last = span.getField("first"), span.getField("last")
    return items.withColumns({
        "year_normalized": (F.col("year") - first) / (last - first),
        "decade": titles.decade(F.col("year")),
        "era": titles.era(F.col("year")),
        "temporal_weight": temporal_weight(F.col("year"), first, last),
    })


def search(
    items: DataFrame, query: str | None = None, genre: str | None = None, year: int | None = None, limit: int = 20
) -> DataFrame:
    """Items whose title holds ``query``, that carry ``genre`` and are from ``year``."""
    if not (query or genre or year):
        raise ValueError("give a query, a genre or a year")
    if not 1 <= limit <= 100:
        raise ValueError("limit must lie between 1 and 100")
    found = items
    if query:
        found = found.where(F.contains(F.lower("clean_title"), F.lower(F.lit(query))))
    if genre:
        found = found.where(F.exists("genres", lambda g: F.lower(g) == F.lower(F.lit(genre))))
    if year:
        found = found.where(F.col("year") == year)
    return found.orderBy("item_id").limit(limit)


def lookup(items: DataFrame, item_id: int) -> DataFrame:
    return items.where(F.col("item_id") == item_id)


def frequent_genres(items: DataFrame, n: int) -> list[str]:
    """The ``n`` most frequent genres; a report of fixed size for the caller."""
    counts = items.select(F.explode("genres").alias("genre")).groupBy("genre").count()
    return [r["genre"] for r in counts.orderBy(F.desc("count"), "genre").limit(n).collect()]


def initial_selection(
    items_with_stats: DataFrame,
    genres: list[str],
    target: int = 30,
    threshold: int = 1000,
    relaxed: int = 500,
    dedupe: bool = False,
) -> DataFrame:
    """A genre-balanced list of much-rated items for the first rating screen.

    Each target genre contributes its most rated items and the free slots go
    to the most rated items left. An item picked for two genres uses up two
    slots unless ``dedupe`` is set.
    """
    n = F.col("rating_count")
    enough = items_with_stats.agg(F.count_if(n >= threshold) >= target).scalar()
    pool = items_with_stats.where(n >= F.when(enough, threshold).otherwise(relaxed))
    per_genre = max(1, target // len(genres))
    order = [F.desc("rating_count"), F.asc("item_id")]
    by_genre = pool.select("item_id", "rating_count", F.explode(F.array_distinct("genres")).alias("genre"))
    by_genre = by_genre.where(F.col("genre").isin(genres))
    picks = top_n(by_genre, ["genre"], per_genre, *order).select("item_id", "genre", "rank")
    position = F.array_position(F.array(*[F.lit(g) for g in genres]), F.col("genre"))
    picks = picks.withColumn("slot", (position - 1) * per_genre + F.col("rank")).select("item_id", "slot")
    # at most len(genres) * per_genre rows from here on
    first_slot = picks.groupBy("item_id").agg(F.min("slot").alias("slot"))
    used = (first_slot if dedupe else picks).agg(F.count("*")).scalar()
    rest = pool.join(first_slot, "item_id", "left_anti")
    rest = rest.orderBy(*order).limit(target).select("item_id", "rating_count")
    rest = top_n(rest.withColumn("all", F.lit(0)), ["all"], target, *order, rank="place")
    fill = rest.where(F.col("place") <= target - used).select("item_id", (F.lit(target) + F.col("place")).alias("slot"))
    chosen = first_slot.unionByName(fill).select("item_id")
    return items_with_stats.join(chosen, "item_id", "left_semi")


def fallback(ratings: DataFrame, items: DataFrame, min_avg: float = 4.0, min_count: int = 100, n: int = 50) -> DataFrame:
    """The best rated of the much-rated items."""
    stats = ratings.groupBy("item_id").agg(
        half_even(F.avg("rating"), 2).alias("avg_rating"), F.count("*").alias("rating_count")
    )
    best = (
        stats.where((F.col("rating_count") >= min_count) & (F.col("avg_rating") >= min_avg))
        .orderBy(F.desc("avg_rating"), F.desc("rating_count"), "item_id")
        .limit(n)
    )
    return best.join(items.select("item_id", "title", "genres_text"), "item_id").withColumn(
        "explanation", F.lit("Popular movie with high ratings")
    )


def genre_importance(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Weight per genre from quality, popularity and prevalence, scaled to 1."""
    per_item = ratings.groupBy("item_id").agg(F.avg("rating").alias("mean"), F.count("*").alias("n"))
    per_genre = (
        items.select("item_id", F.explode("genres").alias("genre"))
        .join(per_item, "item_id")
        .groupBy("genre")
        .agg(F.avg("mean").alias("avg"), F.avg("n").alias("pop"), F.count("*").alias("items"))
        .select("genre", "items", (F.col("avg") / 5 * F.log1p("pop") * F.log1p("items")).alias("raw"))
    )
    top = per_genre.agg(F.max("raw")).scalar()
    return per_genre.select("genre", "items", (F.col("raw") / top).alias("importance"))


def weighted_genre_score(items: DataFrame, importance: DataFrame) -> DataFrame:
    """Mean importance of an item's genres; unknown genres add nothing."""
    scored = (
        items.select("item_id", F.explode("genres").alias("genre"))
        .join(importance.select("genre", "importance"), "genre", "left")
        .groupBy("item_id")
        .agg(F.sum(F.coalesce("importance", F.lit(0.0))).alias("total"))
    )
    return items.join(scored, "item_id", "left").select(
        "item_id",
        F.when(F.size("genres") == 0, 0.0).otherwise(F.col("total") / F.size("genres")).alias("weighted_genre_score"),
    )


def best_metadata(items: DataFrame, metadata: DataFrame) -> DataFrame:
    """One metadata row per item: same year first, then one year off, then any.

    ``metadata`` holds ``search_title``, ``release_year``, ``position`` and
    ``meta_id``; candidates meet on the cleaned title.
    """
    left = items.select("item_id", "year", titles.search_title(F.col("clean_title")).alias("search_title"))

    def candidate(entry):
        gap = F.abs(entry["release_year"] - F.col("year"))
        tier = F.when(gap == 0, 0).when(gap <= 1, 1).otherwise(2)
        return F.struct(tier.alias("tier"), entry["first"]["position"].alias("position"), entry["first"]["meta_id"].alias("meta_id"))

    # a title's candidates shrink to one per release year, which meet an item in one row
    years = metadata.groupBy("search_title", "release_year").agg(F.min(F.struct("position", "meta_id")).alias("first"))
    years = years.groupBy("search_title").agg(F.collect_list(F.struct("release_year", "first")).alias("years"))
    return (
        left.join(years, "search_title")
        .select("item_id", F.array_min(F.transform("years", candidate)).alias("best"))
        .groupBy("item_id")
        .agg(F.min("best").alias("best"))
        .select("item_id", "best.tier", "best.meta_id")
    )
