"""Splits, neighbourhood models, baselines and their errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import collaborative as cf, evaluation, splits
from starloom.plans.base import Group, rounded
from starloom.plans.oracle import cte
from starloom.session import materialize
from starloom.sources import tables

group = Group()
query, QUERIES, ORACLES = group.query, group.queries, group.oracles

MIN_USER, MIN_ITEM = 20, 25
K, N = 50, 10

cte("active", f"""
SELECT * FROM ratings
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= {MIN_USER})
  AND item_id IN (SELECT item_id FROM ratings GROUP BY item_id HAVING count(*) >= {MIN_ITEM})
""", "ratings")
cte("strat", """
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(user_id || '_' || item_id), item_id)
          <= ceil(count(*) OVER (PARTITION BY user_id) * CAST(0.2 AS DOUBLE)) AS is_test
FROM ratings
""", "ratings")
cte("train", "SELECT user_id, item_id, rating, ts FROM strat WHERE NOT is_test", "strat")
cte("test", "SELECT user_id, item_id, rating, ts FROM strat WHERE is_test", "strat")
cte("temporal", """
SELECT *, row_number() OVER (ORDER BY ts, user_id, item_id) > (SELECT floor(count(*) * CAST(0.8 AS DOUBLE)) FROM ratings) AS is_test FROM ratings
""", "ratings")


def sims_cte(name: str, source: str, of: str, dim: str) -> None:
    cte(name, f"""
WITH norms AS (SELECT {of} AS id, sqrt(sum(rating * rating)) AS norm FROM {source} GROUP BY {of}),
dots AS (SELECT a.{of} AS id, b.{of} AS other, sum(a.rating * b.rating) AS dot
  FROM {source} a JOIN {source} b ON a.{dim} = b.{dim} AND a.{of} <> b.{of} GROUP BY a.{of}, b.{of})
SELECT d.id, d.other, dot / (x.norm * y.norm) AS score
FROM dots d JOIN norms x ON x.id = d.id JOIN norms y ON y.id = d.other
""", source)


def top_cte(name: str, sims: str, k: int = K) -> None:
    cte(name, f"""
SELECT id, other, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other) AS rank FROM {sims})
WHERE rank <= {k}
""", sims)


for _source in ("ratings", "train"):
    sims_cte(f"item_sims_{_source}", _source, "item_id", "user_id")
    sims_cte(f"user_sims_{_source}", _source, "user_id", "item_id")
    top_cte(f"item_top_{_source}", f"item_sims_{_source}")
    top_cte(f"user_top_{_source}", f"user_sims_{_source}")
top_cte("user_top49_train", "user_sims_train", 49)
cte("item_candidates", """
SELECT user_id, item_id, least(5, greatest(1, raw)) AS predicted FROM (
  SELECT r.user_id, t.id AS item_id, sum(t.score * r.rating) / sum(abs(t.score)) AS raw
  FROM ratings r JOIN item_top_ratings t ON t.other = r.item_id GROUP BY r.user_id, t.id) c
WHERE NOT EXISTS (SELECT 1 FROM ratings x WHERE x.user_id = c.user_id AND x.item_id = c.item_id)
""", "ratings", "item_top_ratings")
cte("user_candidates", """
SELECT user_id, item_id, least(5, greatest(1, raw)) AS predicted FROM (
  SELECT t.id AS user_id, r.item_id, sum(t.score * r.rating) / sum(abs(t.score)) AS raw
  FROM user_top_ratings t JOIN ratings r ON t.other = r.user_id GROUP BY t.id, r.item_id) c
WHERE NOT EXISTS (SELECT 1 FROM ratings x WHERE x.user_id = c.user_id AND x.item_id = c.item_id)
""", "ratings", "user_top_ratings")
# every unrated item of every user: what a model does not reach scores the mean rating
for _model in ("item", "user"):
    cte(f"{_model}_complete", f"""
SELECT u.user_id, i.item_id, coalesce(c.predicted, (SELECT avg(rating) FROM ratings)) AS predicted
FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN (SELECT DISTINCT item_id FROM ratings) i
LEFT JOIN {_model}_candidates c ON c.user_id = u.user_id AND c.item_id = i.item_id
LEFT JOIN ratings r ON r.user_id = u.user_id AND r.item_id = i.item_id WHERE r.user_id IS NULL
""", "ratings", f"{_model}_candidates")
cte("pred_item", """
SELECT t.user_id, t.item_id, t.rating, coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, (SELECT avg(rating) FROM train)) AS predicted
FROM test t LEFT JOIN (
  SELECT t.user_id, t.item_id, sum(n.score * r.rating) / sum(abs(n.score)) AS raw
  FROM test t JOIN item_top_train n ON n.id = t.item_id JOIN train r ON r.user_id = t.user_id AND r.item_id = n.other
  GROUP BY t.user_id, t.item_id) p ON p.user_id = t.user_id AND p.item_id = t.item_id
""", "train", "test", "item_top_train")
cte("pred_user", """
SELECT t.user_id, t.item_id, t.rating, coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, (SELECT avg(rating) FROM train)) AS predicted
FROM test t LEFT JOIN (
  SELECT t.user_id, t.item_id, sum(n.score * r.rating) / sum(abs(n.score)) AS raw
  FROM test t JOIN user_top_train n ON n.id = t.user_id JOIN train r ON r.user_id = n.other AND r.item_id = t.item_id
  GROUP BY t.user_id, t.item_id) p ON p.user_id = t.user_id AND p.item_id = t.item_id
""", "train", "test", "user_top_train")
cte("pred_all", """
SELECT t.user_id, t.item_id, t.rating, coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, 3.0) AS predicted
FROM test t LEFT JOIN (
  SELECT t.user_id, t.item_id, sum(n.score * r.rating) / sum(abs(n.score)) AS raw
  FROM test t JOIN train r ON r.user_id = t.user_id JOIN item_sims_train n ON n.id = t.item_id AND n.other = r.item_id
  GROUP BY t.user_id, t.item_id) p ON p.user_id = t.user_id AND p.item_id = t.item_id
""", "train", "test", "item_sims_train")
cte("pred_bias", """
SELECT t.user_id, t.item_id, t.rating, least(5, greatest(1, g + coalesce(0.5 * (um - g), 0) + coalesce(0.5 * (im - g), 0))) AS predicted
FROM test t CROSS JOIN (SELECT avg(rating) AS g FROM train)
LEFT JOIN (SELECT user_id, avg(rating) AS um FROM train GROUP BY user_id) u ON u.user_id = t.user_id
LEFT JOIN (SELECT item_id, avg(rating) AS im FROM train GROUP BY item_id) i ON i.item_id = t.item_id
""", "train", "test")


def split_ratings(spark, folder):
    """Stored train and test rows of the per-user hashed split."""
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    split = materialize(splits.stratified_split(ratings), "split")
    return splits.train_test(split)


def train_mean(train):
    return train.agg(F.avg("rating")).scalar()


# ---- splits

@query("e4_temporal_split", "SELECT user_id, item_id, is_test FROM temporal", "temporal")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return splits.temporal_split(ratings).select("user_id", "item_id", "is_test")


@query("e5_user_time_split", """
SELECT user_id, item_id, n >= 5 AND pos > n - greatest(1, floor(n * CAST(0.2 AS DOUBLE))) AS is_test FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS pos FROM ratings)
""", "ratings")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return splits.user_time_split(ratings).select("user_id", "item_id", "is_test")


@query("e6_stratified_split", "SELECT user_id, item_id, is_test FROM strat", "strat")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return splits.stratified_split(ratings).select("user_id", "item_id", "is_test")


@query("e7_sampled_ratings", """
SELECT user_id, item_id, rating FROM ratings ORDER BY md5(user_id || '_' || item_id), user_id, item_id LIMIT 1000
""", "ratings")
def _(spark, folder):
    return splits.sample_rows(tables.ratings(spark, folder), 1000).select("user_id", "item_id", "rating")


@query("s1_cold_start_ids", """
SELECT 'user_id' AS kind, user_id AS id FROM (SELECT user_id FROM temporal WHERE is_test EXCEPT SELECT user_id FROM temporal WHERE NOT is_test)
UNION ALL
SELECT 'item_id', item_id FROM (SELECT item_id FROM temporal WHERE is_test EXCEPT SELECT item_id FROM temporal WHERE NOT is_test)
""", "temporal")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return splits.cold_start(*splits.train_test(splits.temporal_split(ratings)))


@query("s3_rejoined_split", "SELECT user_id, item_id, rating FROM ratings", "ratings")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    return train.unionByName(test).select("user_id", "item_id", "rating")


# ---- similarities and neighbours

@query("f1_active_ratings", "SELECT user_id, item_id, rating FROM active", "active")
def _(spark, folder):
    return cf.active_ratings(tables.ratings(spark, folder), MIN_USER, MIN_ITEM).select("user_id", "item_id", "rating")


@query("f2_user_item_table", """
SELECT o_custkey AS user_id, l_partkey + 1 AS item_id, round(avg(1 + floor((l_quantity - 1) / 10)), 6) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey + 1
""")
def _(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    events = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        (F.col("l_partkey") + 1).alias("item_id"),
        (1 + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating"),
    )
    return rounded(cf.user_item(events), "rating")


@query("f3_item_cosine", "SELECT id, other, round(score, 6) AS score FROM item_sims_ratings WHERE score > 0.1", "item_sims_ratings")
def _(spark, folder):
    return rounded(cf.similar(tables.ratings(spark, folder), "item_id", min_score=0.1), "score")


@query("f4_user_cosine", "SELECT id, other, round(score, 6) AS score FROM user_sims_ratings WHERE score > 0.1", "user_sims_ratings")
def _(spark, folder):
    return rounded(cf.similar(tables.ratings(spark, folder), "user_id", min_score=0.1), "score")


@query("e1_item_neighbours", "SELECT id, other, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM item_top_ratings", "item_top_ratings")
def _(spark, folder):
    return rounded(cf.neighbours(tables.ratings(spark, folder), "item_id", K), "score")


@query("e1_user_neighbours", "SELECT id, other, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM user_top_ratings", "user_top_ratings")
def _(spark, folder):
    return rounded(cf.neighbours(tables.ratings(spark, folder), "user_id", K), "score")


RANKED = f"""
SELECT user_id, item_id, round(predicted, 6) AS predicted, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(predicted, 9) DESC, item_id) AS rank FROM {{}})
WHERE rank <= {N}
"""


@query("e2_item_knn_recommendations", RANKED.format("item_complete"), "item_complete")
def _(spark, folder):
    return rounded(cf.item_knn_recommendations(tables.ratings(spark, folder), K, N), "predicted")


# with few neighbours most items are reached by no rated one, so many lists end with the mean rating
FEW, LONG = 5, 100
top_cte("item_top5_ratings", "item_sims_ratings", FEW)
cte("item_few", """
SELECT u.user_id, i.item_id, coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, (SELECT avg(rating) FROM ratings)) AS predicted
FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN (SELECT DISTINCT item_id FROM ratings) i
LEFT JOIN (SELECT r.user_id, t.id AS item_id, sum(t.score * r.rating) / sum(abs(t.score)) AS raw
  FROM ratings r JOIN item_top5_ratings t ON t.other = r.item_id GROUP BY r.user_id, t.id) c ON c.user_id = u.user_id AND c.item_id = i.item_id
LEFT JOIN ratings r ON r.user_id = u.user_id AND r.item_id = i.item_id WHERE r.user_id IS NULL
""", "ratings", "item_top5_ratings")


@query("e2_item_knn_few_neighbours", f"""
SELECT user_id, item_id, round(round(predicted, 9), 6) AS predicted, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(predicted, 9) DESC, item_id) AS rank FROM item_few)
WHERE rank <= {LONG}
""", "item_few")
def _(spark, folder):
    # means of few whole ratings often lie exactly between two roundings
    return rounded(rounded(cf.item_knn_recommendations(tables.ratings(spark, folder), FEW, LONG), "predicted", digits=9), "predicted")


@query("d9_user_candidates", RANKED.format("user_complete"), "user_complete")
def _(spark, folder):
    return rounded(cf.user_knn_recommendations(tables.ratings(spark, folder), K, N), "predicted")


# ---- predictions on held-out rows

@query("f5_item_knn_predictions", "SELECT user_id, item_id, rating, round(predicted, 6) AS predicted FROM pred_item", "pred_item")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    out = cf.predict_by_item(test, cf.neighbours(train, "item_id", K), train, train_mean(train))
    return rounded(out.select("user_id", "item_id", "rating", "predicted"), "predicted")


@query("f6_user_knn_predictions", "SELECT user_id, item_id, rating, round(predicted, 6) AS predicted FROM pred_user", "pred_user")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    out = cf.predict_by_user(test, cf.neighbours(train, "user_id", K), train, train_mean(train))
    return rounded(out.select("user_id", "item_id", "rating", "predicted"), "predicted")


@query("f7_all_items_predictions", "SELECT user_id, item_id, rating, round(predicted, 6) AS predicted FROM pred_all", "pred_all")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    out = cf.predict_by_all_items(test, train)
    return rounded(out.select("user_id", "item_id", "rating", "predicted"), "predicted")


@query("f8_user_product_predictions", """
SELECT t.user_id, t.item_id, t.rating, round(coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, 3.0), 6) AS predicted
FROM test t LEFT JOIN (
  SELECT t.user_id, t.item_id, avg(n.score * r.rating) AS raw
  FROM test t JOIN user_top49_train n ON n.id = t.user_id JOIN train r ON r.user_id = n.other AND r.item_id = t.item_id
  GROUP BY t.user_id, t.item_id) p ON p.user_id = t.user_id AND p.item_id = t.item_id
""", "train", "test", "user_top49_train")
def _(spark, folder):
    # the user's own row takes one of the fifty places
    train, test = split_ratings(spark, folder)
    out = cf.predict_by_user_product(test, cf.neighbours(train, "user_id", K - 1), train)
    return rounded(out.select("user_id", "item_id", "rating", "predicted"), "predicted")


@query("f13_knn_ensemble", f"""
SELECT user_id, item_id, round(item_knn, 6) AS item_knn, round(user_knn, 6) AS user_knn, round(mean, 6) AS average_prediction, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(mean, 9) DESC, item_id) AS rank FROM (
  SELECT user_id, item_id, i.predicted AS item_knn, u.predicted AS user_knn, (i.predicted + u.predicted) / 2 AS mean
  FROM item_complete i JOIN user_complete u USING (user_id, item_id)))
WHERE rank <= {N}
""", "item_complete", "user_complete")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    models = {
        "item_knn": cf.item_candidates(cf.neighbours(ratings, "item_id", K), ratings),
        "user_knn": cf.user_candidates(cf.neighbours(ratings, "user_id", K), ratings),
    }
    return rounded(cf.ensemble(models, ratings, N).select("user_id", "item_id", *models, "average_prediction", "rank"), "item_knn", "user_knn", "average_prediction")


@query("f14_bias_baseline", "SELECT user_id, item_id, rating, round(round(predicted, 9), 6) AS predicted FROM pred_bias", "pred_bias")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    out = cf.bias_baseline(train, test).select("user_id", "item_id", "rating", "predicted")
    # the global mean cancels out, so many values lie exactly between two roundings
    return rounded(rounded(out, "predicted", digits=9), "predicted")


@query("f15_cold_start_mean", """
SELECT t.user_id, t.item_id, round(coalesce(CASE WHEN n >= 24 THEN least(5, greatest(1, m)) END, 3.5), 6) AS predicted
FROM test t LEFT JOIN (SELECT item_id, avg(rating) AS m, count(*) AS n FROM train GROUP BY item_id) i ON i.item_id = t.item_id
""", "train", "test")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    return rounded(cf.cold_start_mean(train, test, min_ratings=24).select("user_id", "item_id", "predicted"), "predicted")


# ---- errors

ERRORS = "round(sqrt(avg((predicted - rating) * (predicted - rating))), 6) AS rmse, round(avg(abs(predicted - rating)), 6) AS mae, count(*) AS n"


@query("c11_baseline_errors", f"SELECT {ERRORS} FROM pred_bias", "pred_bias")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    return rounded(evaluation.rating_errors(cf.bias_baseline(train, test)), "rmse", "mae")


@query("c12_prediction_correlation", "SELECT round(corr(predicted, rating), 6) AS correlation FROM pred_bias", "pred_bias")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    return rounded(evaluation.prediction_correlation(cf.bias_baseline(train, test)), "correlation")


@query("c15_warm_cold_errors", f"""
WITH tr AS (SELECT * FROM temporal WHERE NOT is_test), te AS (SELECT * FROM temporal WHERE is_test), p AS (
  SELECT te.rating, u.um IS NOT NULL AS is_warm,
         least(5, greatest(1, g + coalesce(0.5 * (um - g), 0) + coalesce(0.5 * (im - g), 0))) AS predicted
  FROM te CROSS JOIN (SELECT avg(rating) AS g FROM tr)
  LEFT JOIN (SELECT user_id, avg(rating) AS um FROM tr GROUP BY user_id) u ON u.user_id = te.user_id
  LEFT JOIN (SELECT item_id, avg(rating) AS im FROM tr GROUP BY item_id) i ON i.item_id = te.item_id)
SELECT is_warm, {ERRORS} FROM p GROUP BY ROLLUP (is_warm)
""".replace("WITH tr", "SELECT * FROM (WITH tr", 1).rstrip() + ")", "temporal")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    train, test = splits.train_test(materialize(splits.temporal_split(ratings), "split"))
    known = train.select("user_id").distinct().withColumn("is_warm", F.lit(True))
    scored = cf.bias_baseline(train, test).join(known, "user_id", "left")
    scored = scored.withColumn("is_warm", F.coalesce("is_warm", F.lit(False)))
    return rounded(evaluation.warm_cold_errors(scored), "rmse", "mae")


@query("j7_model_errors", f"""
SELECT model, {ERRORS} FROM (
  SELECT 'item_knn' AS model, * FROM pred_item UNION ALL SELECT 'user_knn', * FROM pred_user UNION ALL SELECT 'bias', * FROM pred_bias)
GROUP BY model
""", "pred_item", "pred_user", "pred_bias")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    models = {
        "item_knn": cf.predict_by_item(test, cf.neighbours(train, "item_id", K), train, train_mean(train)),
        "user_knn": cf.predict_by_user(test, cf.neighbours(train, "user_id", K), train, train_mean(train)),
        "bias": cf.bias_baseline(train, test),
    }
    union = None
    for name, df in models.items():
        part = df.select(F.lit(name).alias("model"), "rating", "predicted")
        union = part if union is None else union.unionByName(part)
    return rounded(evaluation.rating_errors(union, "model"), "rmse", "mae")


# ---- ranking quality

cte("recs_train", """
SELECT model, user_id, item_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY model, user_id ORDER BY round(predicted, 9) DESC, item_id) AS rank FROM (
    SELECT m.model, u.user_id, i.item_id, coalesce(c.predicted, (SELECT avg(rating) FROM train)) AS predicted
    FROM (VALUES ('item_knn'), ('user_knn')) m(model) CROSS JOIN (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT DISTINCT item_id FROM train) i
    LEFT JOIN (
      SELECT 'item_knn' AS model, r.user_id, t.id AS item_id, least(5, greatest(1, sum(t.score * r.rating) / sum(abs(t.score)))) AS predicted
      FROM train r JOIN item_top_train t ON t.other = r.item_id GROUP BY r.user_id, t.id
      UNION ALL
      SELECT 'user_knn', t.id, r.item_id, least(5, greatest(1, sum(t.score * r.rating) / sum(abs(t.score))))
      FROM user_top_train t JOIN train r ON t.other = r.user_id GROUP BY t.id, r.item_id) c
      ON c.model = m.model AND c.user_id = u.user_id AND c.item_id = i.item_id
    LEFT JOIN train x ON x.user_id = u.user_id AND x.item_id = i.item_id WHERE x.user_id IS NULL))
WHERE rank <= 20
""", "train", "item_top_train", "user_top_train")
cte("ranking", """
SELECT m.model, u.user_id, k.k, coalesce(h.hits, 0) / CAST(k.k AS DOUBLE) AS "precision",
       CASE WHEN n_relevant = 0 THEN 0.0 ELSE coalesce(h.hits, 0) / CAST(n_relevant AS DOUBLE) END AS recall,
       CASE WHEN coalesce(h.hits, 0) > 0 THEN 1.0 ELSE 0.0 END AS hit
FROM (SELECT user_id, count_if(rating >= 4) AS n_relevant FROM test GROUP BY user_id) u
CROSS JOIN (SELECT DISTINCT model FROM recs_train) m CROSS JOIN (SELECT unnest([5, 10, 20]) AS k) k
LEFT JOIN (
  SELECT model, user_id, kk.k, count_if(rank <= kk.k) AS hits
  FROM recs_train JOIN test USING (user_id, item_id) CROSS JOIN (SELECT unnest([5, 10, 20]) AS k) kk
  WHERE rating >= 4 GROUP BY model, user_id, kk.k) h ON h.model = m.model AND h.user_id = u.user_id AND h.k = k.k
""", "test", "recs_train")
cte("ranking_summary", """
SELECT model, k, p AS "precision", r AS recall, h AS hit_rate, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1
FROM (SELECT model, k, avg("precision") AS p, avg(recall) AS r, avg(hit) AS h FROM ranking GROUP BY model, k)
""", "ranking")


def train_recommendations(spark, folder):
    """Stored lists of both neighbourhood models, and the test rows."""
    train, test = split_ratings(spark, folder)
    return materialize(named({
        "item_knn": cf.item_knn_recommendations(train, K, 20),
        "user_knn": cf.user_knn_recommendations(train, K, 20),
    }), "recs"), test


def named(lists):
    union = None
    for name, df in lists.items():
        part = df.select(F.lit(name).alias("model"), "user_id", "item_id", "rank")
        union = part if union is None else union.unionByName(part)
    return union


@query("j1_relevant_items", "SELECT user_id, item_id FROM test WHERE rating >= 4", "test")
def _(spark, folder):
    return evaluation.relevant(split_ratings(spark, folder)[1])


@query("j2_j3_ranking_per_user", 'SELECT model, user_id, k, round("precision", 6) AS "precision", round(recall, 6) AS recall, CAST(hit AS DOUBLE) AS hit FROM ranking', "ranking")
def _(spark, folder):
    return rounded(evaluation.ranking_per_user(*train_recommendations(spark, folder)), "precision", "recall")


@query("j4_ranking_summary", """
SELECT model, k, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(hit_rate, 6) AS hit_rate, round(f1, 6) AS f1 FROM ranking_summary
""", "ranking_summary")
def _(spark, folder):
    summary = evaluation.ranking_summary(evaluation.ranking_per_user(*train_recommendations(spark, folder)))
    return rounded(summary, "precision", "recall", "hit_rate", "f1")


@query("j5_catalogue_coverage", """
SELECT model, k, round(count(DISTINCT CASE WHEN rank <= k THEN item_id END) / CAST((SELECT count(*) FROM items) AS DOUBLE), 6) AS coverage
FROM recs_train CROSS JOIN (SELECT unnest([5, 10, 20]) AS k) GROUP BY model, k
""", "recs_train", "items")
def _(spark, folder):
    recs, _ = train_recommendations(spark, folder)
    return rounded(evaluation.coverage(recs, tables.items(spark, folder)), "coverage")


@query("j6_best_models", """
SELECT metric, k, model, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY metric, k ORDER BY round(value, 9) DESC, model) AS rn
  FROM (UNPIVOT ranking_summary ON "precision", recall, f1, hit_rate INTO NAME metric VALUE value))
WHERE rn = 1
""", "ranking_summary")
def _(spark, folder):
    summary = evaluation.ranking_summary(evaluation.ranking_per_user(*train_recommendations(spark, folder)))
    return rounded(evaluation.best_models(summary), "value")


@query("j9_relative_change", """
SELECT model, round((b - rmse) / b, 6) AS improvement FROM (
  SELECT model, sqrt(avg((predicted - rating) * (predicted - rating))) AS rmse FROM (
    SELECT 'item_knn' AS model, * FROM pred_item UNION ALL SELECT 'user_knn', * FROM pred_user) GROUP BY model)
CROSS JOIN (SELECT sqrt(avg((predicted - rating) * (predicted - rating))) AS b FROM pred_bias)
""", "pred_item", "pred_user", "pred_bias")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    item = cf.predict_by_item(test, cf.neighbours(train, "item_id", K), train, train_mean(train))
    user = cf.predict_by_user(test, cf.neighbours(train, "user_id", K), train, train_mean(train))
    scored = item.select(F.lit("item_knn").alias("model"), "rating", "predicted").unionByName(
        user.select(F.lit("user_knn").alias("model"), "rating", "predicted")
    )
    base = evaluation.rating_errors(cf.bias_baseline(train, test)).select("rmse").scalar()
    errors = evaluation.rating_errors(scored, "model").withColumn("base", base)
    return rounded(errors.select("model", evaluation.relative_change("rmse", "base").alias("improvement")), "improvement")
