"""Rating errors and ranking quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rating_errors(predictions: DataFrame, *keys: str) -> DataFrame:
    """RMSE, MAE and row count of ``predicted`` against ``rating`` per key."""
    error = F.col("predicted") - F.col("rating")
    return predictions.groupBy(*keys).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.count("*").alias("n")
    )


def warm_cold_errors(predictions: DataFrame) -> DataFrame:
    """Errors of known users, of new users and overall (null flag)."""
    error = F.col("predicted") - F.col("rating")
    return predictions.rollup("is_warm").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.count("*").alias("n")
    )


def prediction_correlation(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.corr("predicted", "rating").alias("correlation"))


def relevant(test: DataFrame, threshold: float = 4.0) -> DataFrame:
    return test.where(F.col("rating") >= threshold).select("user_id", "item_id")


def ranking_per_user(recs: DataFrame, test: DataFrame, ks: tuple[int, ...] = (5, 10, 20), threshold: float = 4.0) -> DataFrame:
    """Precision, recall and hit per model, test user and cut-off.

    ``recs`` holds ``(model, user_id, item_id, rank)``. Test users without
    recommendations or without a relevant item score 0.
    """
    truth = relevant(test, threshold)
    sizes = test.groupBy("user_id").agg(F.count_if(F.col("rating") >= threshold).alias("n_relevant"))
    hits = recs.join(truth, ["user_id", "item_id"], "left_semi").groupBy("model", "user_id").agg(
        *[F.count_if(F.col("rank") <= k).alias(f"h{k}") for k in ks]
    )
    models = recs.select("model").distinct()
    # a handful of models: one row per model and test user
    grid = sizes.withColumn("models", models.agg(F.collect_set("model")).scalar()).select(
        F.explode("models").alias("model"), "user_id", "n_relevant"
    )
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(f"h{k}", F.lit(0)).alias("hits")) for k in ks])
    rows = grid.join(hits, ["model", "user_id"], "left").select(
        "model", "user_id", "n_relevant", F.inline(cuts)
    )
    return rows.select(
        "model", "user_id", "k",
        (F.col("hits") / F.col("k")).alias("precision"),
        F.coalesce(F.col("hits") / F.nullif(F.col("n_relevant"), F.lit(0)), F.lit(0.0)).alias("recall"),
        F.when(F.col("hits") > 0, 1.0).otherwise(0.0).alias("hit"),
    )


def ranking_summary(per_user: DataFrame) -> DataFrame:
    """Averages over users; F1 comes from the averaged precision and recall."""
    p, r = F.col("precision"), F.col("recall")
    means = per_user.groupBy("model", "k").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("hit").alias("hit_rate")
    )
    return means.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def coverage(recs: DataFrame, items: DataFrame, ks: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """Share of the catalogue recommended to anyone, per model and cut-off."""
    total = items.agg(F.count("*")).scalar()
    best = recs.groupBy("model", "item_id").agg(F.min("rank").alias("rank"))
    counts = best.groupBy("model").agg(*[F.count_if(F.col("rank") <= k).alias(f"n{k}") for k in ks])
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), (F.col(f"n{k}") / total).alias("coverage")) for k in ks])
    return counts.select("model", F.inline(cuts))


def best_models(summary: DataFrame, metrics: tuple[str, ...] = ("precision", "recall", "f1", "hit_rate")) -> DataFrame:
    """The model that leads each metric at each cut-off; ties by name."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, 9).alias("value")) for m in metrics])
    long = summary.select("model", "k", F.inline(cells))
    best = long.groupBy("metric", "k").agg(F.min(F.struct((-F.col("value")).alias("neg"), "model")).alias("best"))
    return best.select("metric", "k", "best.model", (-F.col("best.neg")).alias("value"))


def relative_change(new: str, old: str):
    return (F.col(old) - F.col(new)) / F.col(old)
