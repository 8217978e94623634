"""Neighbourhood models over the long user-item table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.scores import HIGH, LOW, by_score, clip, top_n
from starloom.operators import asked, blocks, gaps, profile, strips
from starloom.session import materialize


def active_ratings(ratings: DataFrame, min_user: int = 10, min_item: int = 5) -> DataFrame:
    """Ratings of users and items with enough ratings, both counted up front."""
    users = profile.activity(ratings, "user_id").where(F.col("n") >= min_user)
    items = profile.activity(ratings, "item_id").where(F.col("n") >= min_item)
    return ratings.join(users, "user_id", "left_semi").join(items, "item_id", "left_semi")


def user_item(ratings: DataFrame) -> DataFrame:
    """One rating per (user, item); absent rows are the zeros of the matrix."""
    return ratings.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def _cells(ratings: DataFrame, of: str) -> DataFrame:
    other = "user_id" if of == "item_id" else "item_id"
    return ratings.select(F.col(of).alias("id"), F.col(other).alias("dim"), F.col("rating").alias("val"))


def vectors(ratings: DataFrame, of: str) -> DataFrame:
    """Unit rating vectors of items (over users) or of users (over items).

    Stored, because the block layout and both block sides read them.
    """
    return materialize(blocks.unit(_cells(ratings, of)), "vectors")


def similar(ratings: DataFrame, of: str, min_score: float = 0.0, **options) -> DataFrame:
    """``(id, other, score)`` for all pairs with a cosine above ``min_score``."""
    if options or min_score <= 0:
        return _nearest(vectors(ratings, of), min_score=min_score, **options)
    cells = _cells(ratings, of)
    norms = materialize(cells.groupBy("id").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("norm")), "norms")
    # other lengths belong to no cosine
    norms = norms.where((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    cells = materialize(cells.join(norms, "id").select("id", "dim", "val", "norm"), "cells")
    sizes = strips.products(cells, cells)
    if sizes[0] <= strips.LIGHT * sizes[1]:
        return strips.above(cells, norms, min_score, sizes)
    return blocks.nearest(cells.select("id", "dim", (F.col("val") / F.col("norm")).alias("val")), min_score=min_score)


def neighbours(ratings: DataFrame, of: str, k: int = 50, **options) -> DataFrame:
    """``(id, other, score, rank)``: the ``k`` most similar items or users."""
    return _nearest(vectors(ratings, of), k=k, **options)


def _nearest(units: DataFrame, k: int | None = None, min_score: float = 0.0, **options) -> DataFrame:
    """By strips where the vectors share few dimensions, as ratings do, else by block products; both are exact."""
    if not options and min_score >= 0:
        sizes = strips.products(units, units)
        if sizes[0] <= strips.LIGHT * sizes[1]:
            return strips.nearest(units, k=k, min_score=min_score, sizes=sizes)
    return blocks.nearest(units, k=k, min_score=min_score, **options)


def _ratio(scored: DataFrame) -> DataFrame:
    weight = F.abs(F.col("score"))
    return scored.groupBy("user_id", "item_id").agg(
        (F.sum(F.col("score") * F.col("rating")) / F.sum(weight)).alias("raw")
    )


def _filled(targets: DataFrame, scored: DataFrame, default: Column) -> DataFrame:
    joined = targets.join(scored.select("user_id", "item_id", "raw"), ["user_id", "item_id"], "left")
    return joined.withColumn("predicted", F.coalesce(clip(F.col("raw")), default)).drop("raw")


def reached_by_item(targets: DataFrame, near_items: DataFrame, train: DataFrame) -> DataFrame:
    near = near_items.select(F.col("id").alias("item_id"), "other", "score")
    rated = train.select("user_id", F.col("item_id").alias("other"), "rating")
    return targets.select("user_id", "item_id").join(near, "item_id").join(rated, ["user_id", "other"])


def _reached_by_user(targets: DataFrame, near_users: DataFrame, train: DataFrame) -> DataFrame:
    near = near_users.select(F.col("id").alias("user_id"), "other", "score")
    rated = train.select(F.col("user_id").alias("other"), "item_id", "rating")
    return targets.select("user_id", "item_id").join(near, "user_id").join(rated, ["other", "item_id"])


def predict_by_item(targets: DataFrame, near_items: DataFrame, train: DataFrame, default: Column) -> DataFrame:
    """Weighted mean of the user's ratings of the item's neighbours."""
    return _filled(targets, _ratio(reached_by_item(targets, near_items, train)), default)


def predict_by_user(targets: DataFrame, near_users: DataFrame, train: DataFrame, default: Column) -> DataFrame:
    """Weighted mean of the neighbours' ratings of the item."""
    return _filled(targets, _ratio(_reached_by_user(targets, near_users, train)), default)


def predict_by_user_product(targets: DataFrame, near_users: DataFrame, train: DataFrame, default: float = 3.0) -> DataFrame:
    """Mean of rating times similarity over neighbours, without normalising."""
    reached = _reached_by_user(targets, near_users, train)
    raw = reached.groupBy("user_id", "item_id").agg(F.avg(F.col("rating") * F.col("score")).alias("raw"))
    return _filled(targets, raw, F.lit(default))


def predict_by_all_items(targets: DataFrame, train: DataFrame, default: float = 3.0, **options) -> DataFrame:
    """Weighted mean over everything the user rated, no neighbour limit.

    Similarities of ratings are never negative, so weighting by the positive
    ones alone gives the same result.
    """
    scored = _weighted(vectors(train, "item_id"), train, targets, **options)
    return _filled(targets, scored.withColumn("raw", F.col("num") / F.col("den")), F.lit(default))


def predict_by_positive(targets: DataFrame, units: DataFrame, train: DataFrame, default: float = 3.0, **options) -> DataFrame:
    """Weighted mean over the rated items with a positive similarity, for unit vectors of any sign."""
    scored = _weighted(units, train, targets, positive=True, **options)
    return _filled(targets, scored.withColumn("raw", F.col("num") / F.col("den")), F.lit(default))


def _weighted(units: DataFrame, history: DataFrame, targets: DataFrame, positive: bool = False, **options) -> DataFrame:
    """User by user; block products only if their options are given."""
    if options:
        return blocks.weighted_scores(units, history, targets, positive=positive, **options)
    return asked.weighted_scores(units, history, targets, positive)


def aligned(cells: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test rating of every cell of the full table, 0 where absent."""
    keys = ["user_id", "item_id"]
    side = lambda df, name: df.select(*keys, F.col("rating").alias(name))
    joined = cells.select(*keys).join(side(train, "train_rating"), keys, "left").join(side(test, "test_rating"), keys, "left")
    return joined.na.fill(0.0, ["train_rating", "test_rating"])


def item_candidates(near_items: DataFrame, ratings: DataFrame, users: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Predictions for every unrated item reached through a rated neighbour, of all users or some, or the ``n`` best of a user."""
    near = near_items.select(F.col("id").alias("item_id"), "other", "score")
    ratings = ratings if users is None else ratings.join(users, "user_id", "left_semi")
    rated = ratings.select("user_id", F.col("item_id").alias("other"), "rating")
    left = rated.select(F.col("user_id").alias("id"), F.col("other").alias("dim"), F.col("rating").alias("val"))
    right = near.select(F.col("item_id").alias("id"), F.col("other").alias("dim"), F.col("score").alias("val"))
    nameless = _ratio(rated.where("user_id IS NULL").join(near, "other"))
    # a user's own dimensions are its rated items
    return _unrated(left, right, "right", None, n).unionByName(_clipped(nameless))


def user_candidates(near_users: DataFrame, ratings: DataFrame, users: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Predictions for every unrated item that a neighbour rated, of all users or some, or the ``n`` best of a user."""
    near = near_users.select(F.col("id").alias("user_id"), "other", "score")
    near = near if users is None else near.join(users, "user_id", "left_semi")
    rated = ratings.select(F.col("user_id").alias("other"), "item_id", "rating")
    left = near.select(F.col("user_id").alias("id"), F.col("other").alias("dim"), F.col("score").alias("val"))
    right = rated.select(F.col("item_id").alias("id"), F.col("other").alias("dim"), F.col("rating").alias("val"))
    nameless = _ratio(near.join(rated.where("item_id IS NULL"), "other"))
    taken = ratings.select(F.col("user_id").alias("id"), F.col("item_id").alias("other"))
    return _unrated(left, right, "left", taken, n).unionByName(_clipped(nameless))


def _unrated(left: DataFrame, right: DataFrame, weight: str, taken: DataFrame | None, n: int | None) -> DataFrame:
    scored = strips.means(left, right, taken, weight, n, LOW, HIGH)
    return scored.select(F.col("id").alias("user_id"), F.col("other").alias("item_id"), F.col("score").alias("predicted"))


def _clipped(scored: DataFrame) -> DataFrame:
    """Sums of ratings without a user or item, which no rated pair excludes."""
    return scored.select("user_id", "item_id", clip(F.col("raw")).alias("predicted"))


def recommend(predictions: DataFrame, n: int = 10, score: str = "predicted") -> DataFrame:
    return top_n(predictions, ["user_id"], n, *by_score(score, "item_id"))


def best_of_all(
    candidates: Callable[[DataFrame | None], DataFrame], ratings: DataFrame, default: Column, n: int = 10,
    score: str = "predicted", taken: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` best unrated items of every user, where items that a model does not reach score ``default``.

    ``candidates(users)`` are the reached items of some users, or of all (at
    least their ``n`` best) if None. Unreached items tie, so only their first ``n`` ids can be listed, and
    only for users whose n-th reached item does not beat the default already.
    ``taken`` lists pairs that are neither reached nor to be filled in.
    """
    best = materialize(recommend(candidates(None), n, score).drop("rank"), "best")
    lists = best.groupBy("user_id").agg(F.count("*").alias("n"), F.min(score).alias("least"))
    unfinished = ratings.select("user_id").distinct().join(lists, "user_id", "left").where(
        F.col("n").isNull() | (F.col("n") < n) | (F.round("least", 9) <= F.round(default, 9))).select("user_id")
    unfinished = materialize(unfinished, "unfinished")
    reached = candidates(unfinished).select("user_id", "item_id").unionByName(
        ratings.join(unfinished, "user_id", "left_semi").select("user_id", "item_id"))
    if taken is not None:
        reached = reached.unionByName(taken.join(unfinished, "user_id", "left_semi").select("user_id", "item_id"))
    filled = gaps.first_missing(unfinished, reached, ratings, n).withColumn(score, default)
    return recommend(best.unionByName(filled, allowMissingColumns=True), n, score)


def mean_rating(ratings: DataFrame) -> Column:
    return ratings.agg(F.avg("rating")).scalar()


def item_knn_recommendations(ratings: DataFrame, k: int = 50, n: int = 10) -> DataFrame:
    """The ``n`` best unrated items of every user by item neighbours, the mean rating for items without evidence."""
    ratings = materialize(ratings, "ratings")
    near = materialize(neighbours(ratings, "item_id", k), "near")
    return best_of_all(lambda users: item_candidates(near, ratings, users, n if users is None else None), ratings, mean_rating(ratings), n)


def user_knn_recommendations(ratings: DataFrame, k: int = 50, n: int = 10) -> DataFrame:
    """The ``n`` best unrated items of every user by user neighbours, the mean rating for items without evidence."""
    ratings = materialize(ratings, "ratings")
    near = materialize(neighbours(ratings, "user_id", k), "near")
    return best_of_all(lambda users: user_candidates(near, ratings, users, n if users is None else None), ratings, mean_rating(ratings), n)


def joined_models(models: dict[str, DataFrame], default: Column) -> DataFrame:
    """A column per model with its prediction for every item that any of them reaches, ``default`` where it does not itself."""
    joined = None
    for name, df in models.items():
        part = df.select("user_id", "item_id", F.col("predicted").alias(name))
        joined = part if joined is None else joined.join(part, ["user_id", "item_id"], "full")
    return joined.select("user_id", "item_id", *[F.coalesce(name, default).alias(name) for name in models])


def _mean_of(names) -> Column:
    return sum(F.col(name) for name in names) / len(names)


def ensemble(models: dict[str, DataFrame], ratings: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best unrated items by the mean of several models' predictions, the mean rating where a model reaches an item not."""
    default = mean_rating(ratings)
    joined = joined_models(models, default).withColumn("average_prediction", _mean_of(models))
    joined = materialize(joined, "joined")
    candidates = lambda users: joined if users is None else joined.join(users, "user_id", "left_semi")
    best = best_of_all(candidates, ratings, default, n, "average_prediction")
    return best.withColumns({name: F.coalesce(name, default) for name in models})


def bias_baseline(train: DataFrame, targets: DataFrame) -> DataFrame:
    """Global mean plus half of the user's and half of the item's bias."""
    overall, users, items = profile.means(train)
    joined = targets.join(users, "user_id", "left").join(items, "item_id", "left")
    bias = lambda c: F.coalesce(0.5 * (F.col(c) - overall), F.lit(0.0))
    predicted = clip(overall + bias("user_mean") + bias("item_mean"))
    return joined.withColumn("predicted", predicted).drop("user_mean", "user_n", "item_mean", "item_n")


def cold_start_mean(train: DataFrame, targets: DataFrame, min_ratings: int = 10, default: float = 3.5) -> DataFrame:
    """The item's mean once it has enough ratings, else a constant."""
    _, _, items = profile.means(train)
    mean = F.when(F.col("item_n") >= min_ratings, clip(F.col("item_mean")))
    return targets.join(items, "item_id", "left").withColumn("predicted", F.coalesce(mean, F.lit(default))).drop(
        "item_mean", "item_n"
    )
