"""Hybrid predictions, recommendation lists, explanations and updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators import blocks, catalog, collaborative as cf, content, evaluation, hybrid, serving, splits
from starloom.plans.base import Group, rounded
from starloom.plans.catalogue import FALLBACK_AVG, FALLBACK_COUNT
from starloom.plans.collaborative import ERRORS, split_ratings
from starloom.plans.oracle import cte
from starloom.session import materialize
from starloom.sources import tables

group = Group()
query, QUERIES, ORACLES = group.query, group.queries, group.oracles

N = 20
CF_EXPLAIN, CONTENT_EXPLAIN = 0.3, 0.3


def ratings_and_vectors(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return ratings, content.basic_vectors(tables.items(spark, folder), ratings)


# ---- hybrid predictions

cte("blend_inputs", """
SELECT a.user_id, a.item_id, a.rating, a.predicted AS collaborative, l.predicted AS content, c.n AS n_ratings
FROM pred_all a JOIN pred_liked l ON l.user_id = a.user_id AND l.item_id = a.item_id
JOIN (SELECT user_id, count(*) AS n FROM train GROUP BY user_id) c ON c.user_id = a.user_id
""", "pred_all", "pred_liked", "train")
cte("grid", """
SELECT 'linear' AS strategy, alpha, rating, least(5, greatest(1, alpha * collaborative + (1 - alpha) * content)) AS predicted
FROM blend_inputs CROSS JOIN (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS alpha)
UNION ALL
SELECT 'switching', 0.7, rating, CASE WHEN n_ratings >= 20 THEN collaborative ELSE content END FROM blend_inputs
UNION ALL
SELECT 'weighted_confidence', 0.7, rating, least(5, greatest(1,
  least(n_ratings / 50.0::DOUBLE, 1) * collaborative + (1 - least(n_ratings / 50.0::DOUBLE, 1)) * content)) FROM blend_inputs
""", "blend_inputs")


def both_on_test(spark, folder):
    train, test = split_ratings(spark, folder)
    items = tables.items(spark, folder)
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return hybrid.both_predictions(test, train, content.basic_vectors(items, ratings))


@query("h1_h2_h3_hybrid_predictions", """
SELECT user_id, item_id, rating, round(least(5, greatest(1, 0.7 * collaborative + 0.3 * content)), 6) AS linear,
       round(CASE WHEN n_ratings >= 20 THEN collaborative ELSE content END, 6) AS switching,
       round(least(5, greatest(1, least(n_ratings / 50.0::DOUBLE, 1) * collaborative
         + (1 - least(n_ratings / 50.0::DOUBLE, 1)) * content)), 6) AS weighted_confidence
FROM blend_inputs
""", "blend_inputs")
def _(spark, folder):
    out = both_on_test(spark, folder).select(
        "user_id", "item_id", "rating",
        hybrid.linear(0.7).alias("linear"),
        hybrid.switching().alias("switching"),
        hybrid.by_confidence().alias("weighted_confidence"),
    )
    return rounded(out, "linear", "switching", "weighted_confidence")


@query("h4_grid_errors", f"SELECT strategy, alpha, {ERRORS} FROM grid GROUP BY strategy, alpha", "grid")
def _(spark, folder):
    return rounded(hybrid.grid_errors(both_on_test(spark, folder)), "rmse", "mae")


@query("h4_best_setting", f"""
SELECT strategy, alpha, rmse, mae FROM (SELECT strategy, alpha, {ERRORS} FROM grid GROUP BY strategy, alpha)
ORDER BY rmse, strategy, alpha LIMIT 1
""", "grid")
def _(spark, folder):
    return rounded(hybrid.best_setting(hybrid.grid_errors(both_on_test(spark, folder))), "rmse", "mae")


@query("h5_hold_one_out", """
WITH t AS (SELECT user_id, item_id, rating FROM ratings),
cf AS (SELECT t.user_id, t.item_id, sum(s.score * r.rating) / sum(s.score) AS raw
  FROM t JOIN ratings r ON r.user_id = t.user_id AND r.item_id <> t.item_id
  JOIN item_sims_ratings s ON s.id = t.item_id AND s.other = r.item_id GROUP BY t.user_id, t.item_id),
cb AS (SELECT t.user_id, t.item_id, avg(s.score * r.rating) AS m
  FROM t JOIN ratings r ON r.user_id = t.user_id AND r.item_id <> t.item_id AND r.rating >= 4
  JOIN content_sims s ON s.id = t.item_id AND s.other = r.item_id GROUP BY t.user_id, t.item_id)
SELECT t.user_id, t.item_id, t.rating, round(coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, 3.0), 6) AS collaborative,
       round(coalesce(CASE WHEN m IS NOT NULL THEN least(5, greatest(1, 3 + 2 * m)) END, 3.0), 6) AS content
FROM t LEFT JOIN cf ON cf.user_id = t.user_id AND cf.item_id = t.item_id LEFT JOIN cb ON cb.user_id = t.user_id AND cb.item_id = t.item_id
""".replace("WITH t AS", "SELECT * FROM (WITH t AS", 1).rstrip() + ")", "ratings", "item_sims_ratings", "content_sims")
def _(spark, folder):
    ratings, vectors = ratings_and_vectors(spark, folder)
    out = hybrid.both_predictions(ratings, ratings, vectors)
    return rounded(out.select("user_id", "item_id", "rating", "collaborative", "content"), "collaborative", "content")


@query("f9_positive_predictions", """
SELECT t.user_id, t.item_id, t.rating, round(coalesce(CASE WHEN raw IS NOT NULL THEN least(5, greatest(1, raw)) END, 3.0), 6) AS predicted
FROM test t LEFT JOIN (
  SELECT t.user_id, t.item_id, sum(s.score * r.rating) / sum(s.score) AS raw
  FROM test t JOIN train r ON r.user_id = t.user_id AND r.item_id <> t.item_id
  JOIN content_sims s ON s.id = t.item_id AND s.other = r.item_id AND s.score > 1e-9
  GROUP BY t.user_id, t.item_id) p ON p.user_id = t.user_id AND p.item_id = t.item_id
""", "train", "test", "content_sims")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    _, vectors = ratings_and_vectors(spark, folder)
    units = materialize(blocks.unit(content.as_dims(vectors)), "units")
    out = cf.predict_by_positive(test, units, train)
    return rounded(out.select("user_id", "item_id", "rating", "predicted"), "predicted")


# ---- lists

def collaborative_cte(name: str, source: str, sims: str, n: int) -> None:
    cte(name, f"""
SELECT user_id, item_id, least(5, greatest(1, raw)) AS predicted, least(0.9::DOUBLE, support / 10.0::DOUBLE) AS confidence, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(raw, 9) DESC, item_id) AS rank FROM (
    SELECT r.user_id, s.id AS item_id, sum(s.score * r.rating) / sum(s.score) AS raw, count(*) AS support
    FROM {source} r JOIN {sims} s ON s.other = r.item_id WHERE s.score > 0.1 GROUP BY r.user_id, s.id) c
  WHERE NOT EXISTS (SELECT 1 FROM {source} x WHERE x.user_id = c.user_id AND x.item_id = c.item_id))
WHERE rank <= {n}
""", source, sims)


collaborative_cte("cf_lists", "ratings", "item_sims_ratings", N)
collaborative_cte("cf_lists_wide", "ratings", "item_sims_ratings", 2 * N)
cte("content_profile", """
SELECT r.user_id, u.feature, sum((r.rating - 3) / 2 * u.val) / any_value(c.n) AS val
FROM ratings r JOIN basic_unit u ON u.id = r.item_id JOIN (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id) c ON c.user_id = r.user_id
GROUP BY r.user_id, u.feature
""", "ratings", "basic_unit")
cte("gram", "SELECT a.feature AS f, b.feature AS g, sum(a.val * b.val) AS val FROM basic_unit a JOIN basic_unit b ON a.id = b.id GROUP BY a.feature, b.feature", "basic_unit")
cte("reach", "SELECT p.user_id, g.g AS feature, sum(p.val * g.val) AS val FROM content_profile p JOIN gram g ON g.f = p.feature GROUP BY p.user_id, g.g", "content_profile", "gram")
cte("ct_lists_wide", f"""
SELECT user_id, item_id, least(5, greatest(1, mean + (score - 0.5) * 2)) AS predicted, least(0.9::DOUBLE, score) AS confidence, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
    SELECT r.user_id, u.id AS item_id, sum(r.val * u.val) AS score FROM reach r JOIN basic_unit u USING (feature) GROUP BY r.user_id, u.id) c
  WHERE score > 0 AND NOT EXISTS (SELECT 1 FROM ratings x WHERE x.user_id = c.user_id AND x.item_id = c.item_id))
JOIN (SELECT user_id, avg(rating) AS mean FROM ratings GROUP BY user_id) USING (user_id)
WHERE rank <= {2 * N}
""", "reach", "basic_unit", "ratings")
cte("hybrid_lists", f"""
SELECT user_id, item_id, least(5, greatest(1, score)) AS predicted, confidence, rank, by_collaborative, by_content FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
    SELECT coalesce(c.user_id, t.user_id) AS user_id, coalesce(c.item_id, t.item_id) AS item_id,
           0.7 * coalesce(c.predicted * c.confidence, 0) + 0.3 * coalesce(t.predicted * t.confidence, 0) AS score,
           0.7 * coalesce(c.confidence, 0) + 0.3 * coalesce(t.confidence, 0) AS confidence,
           c.user_id IS NOT NULL AS by_collaborative, t.user_id IS NOT NULL AS by_content
    FROM cf_lists_wide c FULL JOIN ct_lists_wide t ON c.user_id = t.user_id AND c.item_id = t.item_id)
  WHERE score > 0)
WHERE rank <= {N}
""", "cf_lists_wide", "ct_lists_wide")
LIST = "user_id, item_id, round(predicted, 6) AS predicted, round(confidence, 6) AS confidence, CAST(rank AS INTEGER) AS rank"


def fallback_list(spark, folder, ratings):
    best = catalog.fallback(ratings, tables.items(spark, folder), FALLBACK_AVG, FALLBACK_COUNT)
    return materialize(best, "fallback")


def hybrid_parts(ratings, vectors):
    collab = materialize(serving.collaborative_lists(ratings, 2 * N), "collab")
    by_content = materialize(serving.content_lists(ratings, vectors, 2 * N), "content")
    return collab, by_content


@query("h6_collaborative_lists", f"SELECT {LIST} FROM cf_lists", "cf_lists")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return rounded(serving.collaborative_lists(ratings, N), "predicted", "confidence")


@query("h7_content_lists", f"SELECT {LIST} FROM ct_lists_wide", "ct_lists_wide")
def _(spark, folder):
    return rounded(serving.content_lists(*ratings_and_vectors(spark, folder), 2 * N), "predicted", "confidence")


@query("h8_d7_hybrid_lists", f"SELECT {LIST}, by_collaborative, by_content FROM hybrid_lists", "hybrid_lists")
def _(spark, folder):
    out = serving.hybrid_lists(*hybrid_parts(*ratings_and_vectors(spark, folder)), N)
    columns = ["user_id", "item_id", "predicted", "confidence", "rank", "by_collaborative", "by_content"]
    return rounded(out.select(columns), "predicted", "confidence")


cte("fallback_lists", f"""
SELECT user_id, item_id, avg_rating AS predicted, 0.6::DOUBLE AS confidence, rank FROM (
  SELECT u.user_id, f.item_id, f.avg_rating, row_number() OVER (PARTITION BY u.user_id ORDER BY avg_rating DESC, rating_count DESC, f.item_id) AS rank
  FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN fallback f
  WHERE NOT EXISTS (SELECT 1 FROM ratings x WHERE x.user_id = u.user_id AND x.item_id = f.item_id))
WHERE rank <= {N}
""", "ratings", "fallback")


@query("h9_fallback_lists", f"SELECT {LIST} FROM fallback_lists", "fallback_lists")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    users = ratings.select("user_id").distinct()
    out = serving.fallback_lists(users, ratings, fallback_list(spark, folder, ratings), N)
    return rounded(out, "predicted", "confidence")


cte("routed", """
SELECT user_id, item_id, predicted, confidence, rank, 'hybrid' AS algorithm FROM hybrid_lists
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= 15)
UNION ALL
SELECT user_id, item_id, predicted, confidence, rank, 'fallback' FROM fallback_lists
WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) < 15)
""", "hybrid_lists", "fallback_lists", "ratings")


def routed(spark, folder):
    ratings, vectors = ratings_and_vectors(spark, folder)
    lists = {"hybrid": serving.hybrid_lists(*hybrid_parts(ratings, vectors), N)}
    return serving.routed_lists(ratings, lists, fallback_list(spark, folder, ratings), "hybrid", N)


@query("h10_routed_lists", f"SELECT {LIST}, algorithm FROM routed", "routed")
def _(spark, folder):
    return rounded(routed(spark, folder), "predicted", "confidence")


@query("h17_list_confidence", "SELECT user_id, round(avg(confidence), 6) AS confidence_score, count(*) AS n FROM routed GROUP BY user_id", "routed")
def _(spark, folder):
    return rounded(serving.list_confidence(routed(spark, folder)), "confidence_score")


def names_cte(name: str, lists: str, history: str, sims: str, m: int, min_score: float) -> None:
    # the few pairs of a list entry and a rated item come first, then their similarity
    cte(f"{name}_asked", f"SELECT l.user_id, l.item_id, r.item_id AS other FROM {lists} l JOIN {history} r ON r.user_id = l.user_id", lists, history)
    cte(name, f"""
SELECT user_id, item_id, count(*) AS n, list(title ORDER BY place) AS names FROM (
  SELECT a.user_id, a.item_id, i.title, row_number() OVER (PARTITION BY a.user_id, a.item_id ORDER BY round(s.score, 9) DESC, s.other) AS place
  FROM {name}_asked a JOIN {sims} s ON s.id = a.item_id AND s.other = a.other AND s.score > {min_score}
  JOIN items i ON i.item_id = a.other)
WHERE place <= {m} GROUP BY user_id, item_id
""", f"{name}_asked", sims, "items")


cte("liked", "SELECT * FROM ratings WHERE rating >= 4", "ratings")
cte("ct_lists", f"SELECT * FROM ct_lists_wide WHERE rank <= {N}", "ct_lists_wide")
names_cte("cf_names", "cf_lists", "ratings", "item_sims_ratings", 3, CF_EXPLAIN)
names_cte("ct_names", "ct_lists", "liked", "content_sims", 2, CONTENT_EXPLAIN)


@query("h11_collaborative_explanations", """
SELECT l.user_id, l.item_id, coalesce('Because you liked ' || CASE n WHEN 1 THEN names[1] WHEN 2 THEN names[1] || ' and ' || names[2]
       WHEN 3 THEN names[1] || ', ' || names[2] || ', and ' || names[3] END, 'Based on your rating patterns') AS explanation
FROM cf_lists l LEFT JOIN cf_names USING (user_id, item_id)
""", "cf_lists", "cf_names")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    lists = materialize(serving.collaborative_lists(ratings, N), "lists")
    out = serving.explain_collaborative(lists, ratings, tables.items(spark, folder), CF_EXPLAIN)
    return out.select("user_id", "item_id", "explanation")


@query("h12_content_explanations", """
SELECT l.user_id, l.item_id, coalesce('Similar content to ' || array_to_string(names, ' and ') || ' which you rated highly',
       'Based on content similarity to your preferences') AS explanation
FROM ct_lists l LEFT JOIN ct_names USING (user_id, item_id)
""", "ct_lists", "ct_names")
def _(spark, folder):
    ratings, vectors = ratings_and_vectors(spark, folder)
    lists = materialize(serving.content_lists(ratings, vectors, N), "lists")
    out = serving.explain_content(lists, ratings, vectors, tables.items(spark, folder), CONTENT_EXPLAIN)
    return out.select("user_id", "item_id", "explanation")


cte("knn_lists", """
SELECT user_id, item_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(predicted, 9) DESC, item_id) AS rank FROM item_complete)
WHERE rank <= 10
""", "item_complete")
names_cte("knn_names", "knn_lists", "liked", "content_sims", 2, CONTENT_EXPLAIN)


@query("h13_offline_explanations", """
SELECT l.user_id, l.item_id, coalesce('Because you liked ' || array_to_string(names, ' and '), 'Recommended based on your preferences') AS explanation
FROM knn_lists l LEFT JOIN knn_names USING (user_id, item_id)
""", "knn_lists", "knn_names")
def _(spark, folder):
    ratings, vectors = ratings_and_vectors(spark, folder)
    lists = materialize(cf.item_knn_recommendations(ratings, 50, 10), "lists")
    out = serving.explain_offline(lists, ratings, vectors, tables.items(spark, folder), CONTENT_EXPLAIN)
    return out.select("user_id", "item_id", "explanation")


@query("h14_diversified_lists", """
SELECT * FROM (WITH RECURSIVE e AS (
  SELECT l.*, round(l.predicted * l.confidence, 9) AS worth, i.genres FROM cf_lists l LEFT JOIN items i USING (item_id)),
g AS (SELECT user_id, genre, min(rank * 1000 + place) AS first_at, list(item_id ORDER BY worth DESC, rank) AS members
  FROM (SELECT user_id, item_id, worth, rank, unnest(genres) AS genre, generate_subscripts(genres, 1) AS place FROM e) GROUP BY user_id, genre),
o AS (SELECT user_id, members, row_number() OVER (PARTITION BY user_id ORDER BY first_at) AS step, count(*) OVER (PARTITION BY user_id) AS n_genres FROM g),
u AS (SELECT user_id, count(*) AS n, list(item_id ORDER BY worth DESC, rank) AS by_worth FROM e GROUP BY user_id),
walk AS (
  SELECT user_id, CAST(0 AS BIGINT) AS step, CAST([] AS BIGINT[]) AS picked FROM u WHERE n > 5 AND user_id IN (SELECT user_id FROM o)
  UNION ALL
  SELECT w.user_id, w.step + 1, list_concat(w.picked,
    list_slice(list_filter(o.members, lambda x: NOT list_contains(w.picked, x)), 1, greatest(2, u.n // o.n_genres)))
  FROM walk w JOIN o ON o.user_id = w.user_id AND o.step = w.step + 1 JOIN u ON u.user_id = w.user_id),
done AS (SELECT user_id, max_by(picked, step) AS picked FROM walk GROUP BY user_id),
whole AS (SELECT user_id, list_concat(picked, list_filter(by_worth, lambda x: NOT list_contains(picked, x))) AS ids FROM done JOIN u USING (user_id)),
placed AS (SELECT user_id, unnest(ids) AS item_id, generate_subscripts(ids, 1) AS place FROM whole)
SELECT l.user_id, l.item_id, round(l.predicted, 6) AS predicted, round(l.confidence, 6) AS confidence, CAST(coalesce(p.place, l.rank) AS INTEGER) AS rank
FROM cf_lists l LEFT JOIN placed p ON p.user_id = l.user_id AND p.item_id = l.item_id)
""", "cf_lists", "items")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    lists = materialize(serving.collaborative_lists(ratings, N), "lists")
    return rounded(serving.diversify(lists, tables.items(spark, folder)), "predicted", "confidence")


# ---- updates

cte("timed", """
SELECT user_id, item_id, rating, ts, n >= 5 AND pos > n - greatest(1, floor(n * CAST(0.1 AS DOUBLE))) AS is_new FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS pos FROM ratings)
""", "ratings")
cte("old_ratings", "SELECT user_id, item_id, rating, ts FROM timed WHERE NOT is_new", "timed")
cte("new_ratings", "SELECT user_id, item_id, rating, ts FROM timed WHERE is_new", "timed")
from starloom.plans.collaborative import sims_cte  # noqa: E402

sims_cte("item_sims_old", "old_ratings", "item_id", "user_id")
collaborative_cte("old_lists", "old_ratings", "item_sims_old", N)
collaborative_cte("old_lists_wide", "old_ratings", "item_sims_old", 2 * N)
cte("updated", f"""
SELECT user_id, item_id, predicted, confidence, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(predicted * confidence, 9) DESC, item_id) AS rank FROM (
    SELECT l.user_id, l.item_id,
           CAST(round_even(round(least(5, greatest(1, l.predicted + (f.new_mean - o.old_mean) * 0.1 + (f.liked - CASE WHEN x.item_id IS NULL THEN 0 ELSE 1 END) * 0.05)), 9), 2) AS DOUBLE) AS predicted,
           CAST(round_even(round(least(0.95::DOUBLE, l.confidence + least(0.1::DOUBLE, f.k * 0.02::DOUBLE)), 9), 2) AS DOUBLE) AS confidence
    FROM old_lists_wide l
    JOIN (SELECT user_id, avg(rating) AS new_mean, count(*) AS k, count_if(rating >= 4) AS liked FROM new_ratings GROUP BY user_id) f ON f.user_id = l.user_id
    JOIN (SELECT user_id, avg(rating) AS old_mean FROM old_ratings GROUP BY user_id) o ON o.user_id = l.user_id
    LEFT JOIN (SELECT user_id, item_id FROM new_ratings WHERE rating >= 4) x ON x.user_id = l.user_id AND x.item_id = l.item_id))
WHERE rank <= {N}
""", "old_lists_wide", "new_ratings", "old_ratings")


def old_and_new(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    split = materialize(splits.user_time_split(ratings, 0.1), "split")
    return ratings, *splits.train_test(split)


@query("h15_incremental_lists", "SELECT user_id, item_id, predicted, confidence, CAST(rank AS INTEGER) AS rank FROM updated", "updated")
def _(spark, folder):
    _, old, new = old_and_new(spark, folder)
    lists = materialize(serving.collaborative_lists(old, 2 * N), "lists")
    return serving.incremental_update(lists, old, new, N).drop("algorithm")


@query("h16_update_routing", """
WITH c AS (SELECT user_id, count_if(NOT is_new) AS old_n, count_if(is_new) AS new_n FROM timed GROUP BY user_id)
SELECT user_id, item_id, round(predicted, 6) AS predicted, CAST(rank AS INTEGER) AS rank, 'collaborative_incremental' AS algorithm
FROM updated WHERE user_id IN (SELECT user_id FROM c WHERE new_n <= 5 AND old_n >= 15)
UNION ALL
SELECT user_id, item_id, round(predicted, 6), CAST(rank AS INTEGER), 'collaborative' FROM cf_lists
WHERE user_id IN (SELECT user_id FROM c WHERE NOT (new_n <= 5 AND old_n >= 15))
""".replace("WITH c AS", "SELECT * FROM (WITH c AS", 1).rstrip() + ")", "timed", "updated", "cf_lists")
def _(spark, folder):
    ratings, old, new = old_and_new(spark, folder)
    counts = old.groupBy("user_id").agg(F.count("*").alias("old_n")).join(
        new.groupBy("user_id").agg(F.count("*").alias("new_n")), "user_id", "full_outer"
    )
    counts = counts.na.fill(0, ["old_n", "new_n"])
    route = counts.withColumn("fast", serving.is_incremental(F.col("old_n"), F.col("new_n"), "collaborative"))
    lists = materialize(serving.collaborative_lists(old, 2 * N), "lists")
    fast = serving.incremental_update(lists, old, new, N).join(route.where("fast"), "user_id", "left_semi")
    full = serving.collaborative_lists(ratings, N).join(route.where("NOT fast"), "user_id", "left_semi")
    columns = ["user_id", "item_id", "predicted", "rank", "algorithm"]
    out = fast.select(columns).unionByName(full.withColumn("algorithm", F.lit("collaborative")).select(columns))
    return rounded(out, "predicted")


@query("s5_h18_merged_ratings", "SELECT session_id, item_id, rating FROM session_ratings", "session_ratings")
def _(spark, folder):
    return tables.latest_session_ratings(tables.sessions(spark, folder)).select("session_id", "item_id", "rating")


@query("s2_common_items", """
SELECT o.user_id, o.item_id FROM old_lists o JOIN cf_lists c ON c.user_id = o.user_id AND c.item_id = o.item_id
""", "old_lists", "cf_lists")
def _(spark, folder):
    ratings, old, _ = old_and_new(spark, folder)
    keys = ["user_id", "item_id"]
    return serving.collaborative_lists(old, N).select(keys).intersect(serving.collaborative_lists(ratings, N).select(keys))


@query("e10_list_positions", "SELECT user_id, item_id, CAST(rank - 1 AS INTEGER) AS position FROM knn_lists", "knn_lists")
def _(spark, folder):
    lists = cf.item_knn_recommendations(tables.ratings(spark, folder), 50, 10)
    return lists.select("user_id", "item_id", (F.col("rank") - 1).alias("position"))


@query("i10_list_delta", """
WITH j AS (
  SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.item_id, n.item_id) AS item_id, o.rank AS r_old, n.rank AS r_new,
         o.predicted AS p_old, n.predicted AS p_new
  FROM old_lists o FULL JOIN cf_lists n ON n.user_id = o.user_id AND n.item_id = o.item_id),
f AS (SELECT *, r_old IS NOT NULL AND r_new IS NOT NULL AND r_old <> r_new AS moved,
             r_old IS NOT NULL AND r_new IS NOT NULL AND abs(round(p_old - p_new, 9)) > 0.1 AS rerated FROM j),
a AS (SELECT user_id, count_if(r_old IS NULL) AS new_items, count(r_old) > 0 AS known,
             CASE WHEN count(r_old) > 0 THEN count_if(r_new IS NULL) ELSE 0 END AS removed_items,
             count_if(moved) AS n_moved, count_if(rerated) AS n_rerated,
             coalesce(array_to_string(list(item_id || ':' || r_old || '>' || r_new ORDER BY item_id) FILTER (WHERE moved)[1:10], ','), '') AS position_changes,
             coalesce(array_to_string(list(item_id || ':' || CAST(round_even(round(p_new - p_old, 9), 2) AS DOUBLE) ORDER BY item_id) FILTER (WHERE rerated)[1:10], ','), '') AS rating_changes
      FROM f GROUP BY user_id)
SELECT user_id, new_items, removed_items, n_moved, n_rerated, position_changes, rating_changes,
       CASE WHEN NOT known THEN 'Initial recommendations generated'
            WHEN new_items + removed_items + n_moved + n_rerated = 0 THEN 'No significant changes'
            ELSE concat_ws('; ', CASE WHEN new_items > 0 THEN new_items || ' new movies added' END,
              CASE WHEN removed_items > 0 THEN removed_items || ' movies removed' END,
              CASE WHEN n_moved > 0 THEN n_moved || ' movies changed position' END,
              CASE WHEN n_rerated > 0 THEN n_rerated || ' movies had rating changes' END) END AS change_summary
FROM a
""".replace("WITH j AS", "SELECT * FROM (WITH j AS", 1).rstrip() + ")", "old_lists", "cf_lists")
def _(spark, folder):
    ratings, old, _ = old_and_new(spark, folder)
    delta = serving.list_delta(serving.collaborative_lists(old, N), serving.collaborative_lists(ratings, N))
    places = F.transform("position_changes", lambda c: F.format_string("%d:%d>%d", c["item_id"], c["old_rank"], c["new_rank"]))
    values = F.transform("rating_changes", lambda c: F.concat(c["item_id"].cast("string"), F.lit(":"), c["change"].cast("string")))
    return delta.withColumns({"position_changes": F.array_join(places, ","), "rating_changes": F.array_join(values, ",")})
