"""Text features, content similarity, profiles and content predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import scores
from starloom.operators import catalog, content, evaluation, splits
from starloom.plans.base import Group, rounded
from starloom.plans.collaborative import ERRORS, split_ratings
from starloom.plans.oracle import cte
from starloom.session import materialize
from starloom.sources import tables

group = Group()
query, QUERIES, ORACLES = group.query, group.queries, group.oracles

# a short list for the check on prose in several languages
STOP_WORDS = ("the", "and", "of", "to", "in", "la", "le", "les", "des", "que", "der", "die", "und", "el", "los")

cte("features", r"""
SELECT i.item_id, genres_text, genres, clean_title, year,
       (year - first) / CAST(last - first AS DOUBLE) AS year_normalized,
       0.5 + 0.5 * ((year - first) / CAST(last - first AS DOUBLE)) AS temporal_weight,
       CAST(floor(year / 10) * 10 AS INTEGER) AS decade,
       CASE WHEN year < 1960 THEN 'Classic' WHEN year < 1980 THEN 'Retro' WHEN year < 1990 THEN 'Eighties'
            WHEN year < 2000 THEN 'Nineties' ELSE 'Modern' END AS era,
       coalesce(CAST(round_even(round(avg_raw, 9), 3) AS DOUBLE), 0) AS avg_rating, coalesce(n, 0) AS num_ratings,
       coalesce(CAST(round_even(round(std_raw, 9), 3) AS DOUBLE), 0) AS rating_std,
       coalesce(CAST(round_even(round(median_raw, 9), 3) AS DOUBLE), 0) AS median_rating,
       ln(1 + coalesce(n, 0)) AS popularity,
       coalesce(CAST(round_even(round(avg_raw, 9), 3) AS DOUBLE), 0) * ln(1 + coalesce(n, 0)) AS quality,
       1 / (1 + coalesce(CAST(round_even(round(std_raw, 9), 3) AS DOUBLE), 0)) AS reliability,
       coalesce(users, 0) / CAST(greatest(coalesce(n, 0), 1) AS DOUBLE) AS engagement,
       len(genres) AS genre_count, len(list_distinct(genres)) / CAST(len(genres) AS DOUBLE) AS genre_diversity,
       length(clean_title) AS title_length, len(regexp_split_to_array(clean_title, '\s+')) AS title_words,
       weighted_genre_score
FROM items i CROSS JOIN year_span LEFT JOIN item_stats_raw USING (item_id)
LEFT JOIN (SELECT item_id, sum(coalesce(importance, 0)) / count(*) AS weighted_genre_score
           FROM item_genres LEFT JOIN genre_weights USING (genre) GROUP BY item_id) USING (item_id)
""", "items", "year_span", "item_stats_raw", "item_genres", "genre_weights")
cte("plain_text", """
SELECT item_id AS id, trim(replace(genres_text, '|', ' ') || ' ' || era || ' decade_' || CAST(decade AS VARCHAR)) AS text FROM features
""", "features")
cte("weighted_text", """
SELECT f.item_id AS id, concat_ws(' ', g.words, lower(era), 'decade_' || CAST(decade AS VARCHAR),
       CASE WHEN avg_rating > 4 THEN 'high_quality' END,
       CASE WHEN popularity > (SELECT quantile_cont(popularity, 0.8) FROM features) THEN 'popular' END) AS text
FROM features f LEFT JOIN (
  SELECT item_id, string_agg(trim(repeat(lower(genre) || ' ', greatest(1, CAST(floor(coalesce(importance, 0.5) * 3) AS INTEGER)))), ' ' ORDER BY pos) AS words
  FROM (SELECT item_id, unnest(genres) AS genre, generate_subscripts(genres, 1) AS pos FROM features) LEFT JOIN genre_weights USING (genre)
  GROUP BY item_id) g USING (item_id)
""", "features", "genre_weights")


def tfidf_ctes(name: str, texts: str, longest: int, min_df: int, max_df: float, size: int, sublinear: bool, stop=()) -> None:
    stops = f"list_filter(w, lambda x: x NOT IN ({', '.join(repr(s) for s in stop)}))" if stop else "w"
    runs = " UNION ALL ".join(
        f"SELECT id, array_to_string(w[i:i + {n - 1}], ' ') AS term FROM (SELECT id, w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM words)"
        for n in range(1, longest + 1)
    )
    cte(f"{name}_tf", f"""
WITH words AS (SELECT id, {stops} AS w FROM (SELECT id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM {texts}))
SELECT id, term, count(*) AS tf FROM ({runs}) GROUP BY id, term
""", texts)
    cte(f"{name}_vocab", f"""
SELECT term, df, row_number() OVER (ORDER BY term) AS feature FROM (
  SELECT term, count(*) AS df, sum(tf) AS freq FROM {name}_tf GROUP BY term
  HAVING count(*) >= {min_df} AND count(*) <= CAST({max_df} AS DOUBLE) * (SELECT count(*) FROM {texts})
  ORDER BY freq DESC, term LIMIT {size})
""", f"{name}_tf", texts)
    tf = "1 + ln(tf)" if sublinear else "tf"
    cte(f"{name}_tfidf", f"""
SELECT id, feature, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS val FROM (
  SELECT id, feature, term, ({tf}) * (ln((1 + (SELECT count(*) FROM {texts})) / CAST(1 + df AS DOUBLE)) + 1) AS w
  FROM {name}_tf JOIN {name}_vocab USING (term))
""", f"{name}_tf", f"{name}_vocab", texts)


def scaled_cte(name: str, columns, low: str, spread: str) -> None:
    rows = "\nUNION ALL ".join(
        f"SELECT item_id AS id, CAST({-1 - i} AS BIGINT) AS feature, '{c}' AS term, "
        f"({c} - (SELECT {low.format(c)} FROM features)) / (SELECT coalesce(nullif({spread.format(c)}, 0), 1) FROM features) AS val FROM features"
        for i, c in enumerate(columns)
    )
    cte(name, rows, "features")


tfidf_ctes("plain", "plain_text", 2, 2, 0.8, 1000, False)
tfidf_ctes("weighted", "weighted_text", 3, 1, 0.7, 2000, True)
cte("doc_text", "SELECT doc_id AS id, text FROM documents")
tfidf_ctes("doc", "doc_text", 1, 2, 0.8, 1000, False, STOP_WORDS)
scaled_cte("zscores", content.BASIC_NUMERICS, "avg({})", "stddev_pop({})")
scaled_cte("minmax", content.ENHANCED_NUMERICS, "min({})", "CAST(max({0}) - min({0}) AS DOUBLE)")
cte("basic_vectors", "SELECT id, feature, val FROM plain_tfidf UNION ALL SELECT id, feature, val FROM zscores", "plain_tfidf", "zscores")
cte("enhanced_vectors", """
SELECT id, feature, 0.6 * val AS val FROM weighted_tfidf UNION ALL SELECT id, feature, 0.4 * val FROM minmax
""", "weighted_tfidf", "minmax")
for _name in ("basic", "enhanced"):
    cte(f"{_name}_unit", f"SELECT id, feature, val / sqrt(sum(val * val) OVER (PARTITION BY id)) AS val FROM {_name}_vectors", f"{_name}_vectors")
cte("content_sims", """
SELECT a.id, b.id AS other, sum(a.val * b.val) AS score
FROM basic_unit a JOIN basic_unit b ON a.feature = b.feature AND a.id <> b.id GROUP BY a.id, b.id
""", "basic_unit")
cte("content_top", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other) AS rank FROM content_sims) WHERE rank <= 10
""", "content_sims")


def basic(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return content.basic_vectors(tables.items(spark, folder), ratings)


def enhanced(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return content.enhanced_vectors(tables.items(spark, folder), ratings)


def features(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    return materialize(content.feature_table(tables.items(spark, folder), ratings), "features")


def enhanced_features(spark, folder):
    """Stored feature table and genre weights of the enhanced model."""
    items, ratings = tables.items(spark, folder), materialize(tables.ratings(spark, folder), "ratings")
    importance = materialize(catalog.genre_importance(items, ratings), "importance")
    return materialize(content.enhanced_table(items, ratings, importance), "features"), importance


@query("g1_feature_table", """
SELECT item_id, round(year_normalized, 6) AS year_normalized, decade, era, avg_rating, num_ratings, rating_std,
       round(popularity, 6) AS popularity, round(quality, 6) AS quality, CAST(genre_count AS INTEGER) AS genre_count,
       CAST(title_length AS INTEGER) AS title_length, CAST(title_words AS INTEGER) AS title_words
FROM features
""", "features")
def _(spark, folder):
    columns = ["item_id", "year_normalized", "decade", "era", "avg_rating", "num_ratings", "rating_std", "popularity",
               "quality", "genre_count", "title_length", "title_words"]
    return rounded(features(spark, folder).select(columns), "year_normalized", "popularity", "quality")


@query("g2_plain_text", "SELECT id, text FROM plain_text", "plain_text")
def _(spark, folder):
    return content.plain_text(features(spark, folder))


@query("g3_weighted_text", "SELECT id, text FROM weighted_text", "weighted_text")
def _(spark, folder):
    return content.weighted_text(*enhanced_features(spark, folder))


@query("g4_item_terms", "SELECT id, term, tf FROM plain_tf", "plain_tf")
def _(spark, folder):
    return content.term_counts(content.plain_text(features(spark, folder)), 2)


@query("g4_document_terms", "SELECT id, term, tf FROM doc_tf", "doc_tf")
def _(spark, folder):
    docs = tables.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return content.term_counts(docs, 1, STOP_WORDS)


@query("g5_vocabulary", "SELECT term, df, feature FROM weighted_vocab", "weighted_vocab")
def _(spark, folder):
    texts = content.weighted_text(*enhanced_features(spark, folder))
    counts = content.term_counts(texts, 3)
    return content.vocabulary(counts, texts.agg(F.count("*")).scalar(), 1, 0.7, 2000)


@query("g6_item_tfidf", "SELECT id, term, round(val, 6) AS val FROM plain_tfidf", "plain_tfidf")
def _(spark, folder):
    return rounded(content.tfidf(content.plain_text(features(spark, folder))).drop("feature"), "val")


@query("g6_weighted_tfidf", "SELECT id, term, round(val, 6) AS val FROM weighted_tfidf", "weighted_tfidf")
def _(spark, folder):
    texts = content.weighted_text(*enhanced_features(spark, folder))
    return rounded(content.tfidf(texts, 3, 1, 0.7, 2000, True).drop("feature"), "val")


@query("g6_document_tfidf", "SELECT id, term, round(val, 6) AS val FROM doc_tfidf", "doc_tfidf")
def _(spark, folder):
    docs = tables.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return rounded(content.tfidf(docs, 1, stop_words=STOP_WORDS).drop("feature"), "val")


@query("g7_zscores", "SELECT id, term, round(val, 6) AS val FROM zscores", "zscores")
def _(spark, folder):
    return rounded(content.zscores(features(spark, folder)).drop("feature"), "val")


@query("g8_minmax", "SELECT id, term, round(val, 6) AS val FROM minmax", "minmax")
def _(spark, folder):
    table, _ = enhanced_features(spark, folder)
    return rounded(content.minmax(table).drop("feature"), "val")


@query("g9_basic_vectors", "SELECT id, feature, round(val, 6) AS val FROM basic_vectors", "basic_vectors")
def _(spark, folder):
    return rounded(basic(spark, folder), "val")


@query("g9_enhanced_vectors", "SELECT id, feature, round(val, 6) AS val FROM enhanced_vectors", "enhanced_vectors")
def _(spark, folder):
    return rounded(enhanced(spark, folder), "val")


@query("g10_content_cosine", "SELECT id, other, round(score, 6) AS score FROM content_sims WHERE score > 0.9", "content_sims")
def _(spark, folder):
    return rounded(content.similar_content(basic(spark, folder), 0.9), "score")


@query("g10_embedding_neighbours", """
WITH u AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT id, other, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT a.id, b.id AS other, list_cosine_similarity(a.v, b.v) AS score,
         row_number() OVER (PARTITION BY a.id ORDER BY round(list_cosine_similarity(a.v, b.v), 9) DESC, b.id) AS rank
  FROM u a JOIN u b ON a.id <> b.id)
WHERE rank <= 10
""")
def _(spark, folder):
    cells = tables.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.posexplode("embedding").alias("feature", "val")
    )
    vectors = cells.withColumn("val", F.col("val").cast("double"))
    return rounded(content.content_neighbours(vectors, 10), "score")


@query("g11_blended_neighbours", """
WITH d AS (SELECT CAST(count(DISTINCT feature) AS DOUBLE) AS d FROM enhanced_vectors),
s AS (SELECT id, sqrt(sum(val * val)) AS norm, sum(val) AS total, sum(val * val) AS sq FROM enhanced_vectors GROUP BY id),
dots AS (SELECT a.id, b.id AS other, sum(a.val * b.val) AS dot FROM enhanced_vectors a JOIN enhanced_vectors b
  ON a.feature = b.feature AND a.id <> b.id GROUP BY a.id, b.id),
blend AS (SELECT x.id, x.other, 0.7 * dot / (a.norm * b.norm) + 0.3 * (dot - a.total * b.total / d)
    / (sqrt(a.sq - a.total * a.total / d) * sqrt(b.sq - b.total * b.total / d)) AS score
  FROM dots x JOIN s a ON a.id = x.id JOIN s b ON b.id = x.other CROSS JOIN d)
SELECT id, other, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, other) AS rank FROM blend)
WHERE rank <= 10
""".replace("WITH d AS", "SELECT * FROM (WITH d AS", 1).rstrip() + ")", "enhanced_vectors")
def _(spark, folder):
    return rounded(content.blended_neighbours(enhanced(spark, folder), 10), "score")


@query("g12_similar_items", "SELECT id, other, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank, title FROM content_top JOIN items ON item_id = other", "content_top", "items")
def _(spark, folder):
    near = content.content_neighbours(basic(spark, folder), 10)
    return rounded(content.recommend_similar(near, tables.items(spark, folder), 10), "score")


def profile_cte(name: str, source: str, vectors: str, weight: str) -> None:
    cte(name, f"""
SELECT r.user_id, v.feature, sum({weight} * v.val) / any_value(t.total) AS val
FROM {source} r JOIN {vectors} v ON v.id = r.item_id
JOIN (SELECT user_id, sum({weight}) AS total FROM {source} r GROUP BY user_id) t ON t.user_id = r.user_id
GROUP BY r.user_id, v.feature
""", source, vectors)


SIMPLE = "(r.rating / 5)"
EMPHATIC = "(CASE WHEN r.rating >= 4 THEN (r.rating / 5) * (r.rating / 5) ELSE r.rating / 5 END)"
profile_cte("profiles", "ratings", "basic_vectors", SIMPLE)
profile_cte("emphatic_profiles", "ratings", "enhanced_vectors", EMPHATIC)


@query("g13_user_profiles", "SELECT user_id, feature, round(val, 6) AS val FROM profiles", "profiles")
def _(spark, folder):
    return rounded(content.user_profiles(tables.ratings(spark, folder), basic(spark, folder)), "val")


@query("g14_emphatic_profiles", "SELECT user_id, feature, round(val, 6) AS val FROM emphatic_profiles", "emphatic_profiles")
def _(spark, folder):
    return rounded(content.user_profiles(tables.ratings(spark, folder), enhanced(spark, folder), content.emphatic_weight), "val")


@query("g15_profile_recommendations", """
SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM (
    SELECT p.user_id, u.id AS item_id, sum(p.val * u.val) / any_value(n.norm) AS score
    FROM profiles p JOIN basic_unit u USING (feature)
    JOIN (SELECT user_id, sqrt(sum(val * val)) AS norm FROM profiles GROUP BY user_id) n ON n.user_id = p.user_id
    GROUP BY p.user_id, u.id) c
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = c.user_id AND r.item_id = c.item_id))
WHERE rank <= 10
""", "profiles", "basic_unit", "ratings")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    vectors = content.basic_vectors(tables.items(spark, folder), ratings)
    return rounded(content.recommend_by_profile(ratings, vectors, 10), "score")


cte("pred_liked", """
SELECT t.user_id, t.item_id, t.rating, coalesce(CASE WHEN m IS NOT NULL THEN least(5, greatest(1, 3 + 2 * m)) END, 3.0) AS predicted
FROM test t LEFT JOIN (
  SELECT t.user_id, t.item_id, avg(r.rating * s.score) AS m
  FROM test t JOIN train r ON r.user_id = t.user_id AND r.rating >= 4 JOIN content_sims s ON s.id = t.item_id AND s.other = r.item_id
  GROUP BY t.user_id, t.item_id) p ON p.user_id = t.user_id AND p.item_id = t.item_id
""", "test", "train", "content_sims")


@query("g16_liked_predictions", "SELECT user_id, item_id, rating, round(predicted, 6) AS predicted FROM pred_liked", "pred_liked")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    out = content.predict_by_liked(test, train, basic(spark, folder))
    return rounded(out.select("user_id", "item_id", "rating", "predicted"), "predicted")


cte("lists", "SELECT t.id, g.genre, count(*) AS n FROM content_top t JOIN item_genres g ON g.item_id = t.other GROUP BY t.id, g.genre", "content_top", "item_genres")


@query("g17_list_diversity", """
SELECT round(avg(entropy), 6) AS average_genre_entropy, (SELECT count(DISTINCT genre) FROM lists) AS covered_genres,
       (SELECT count(DISTINCT genre) FROM item_genres) AS possible_genres,
       round((SELECT count(DISTINCT genre) FROM lists) / CAST((SELECT count(DISTINCT genre) FROM item_genres) AS DOUBLE), 6) AS genre_coverage
FROM (SELECT id, -sum(p * log2(p)) AS entropy FROM (
  SELECT id, genre, n / CAST(sum(n) OVER (PARTITION BY id) AS DOUBLE) AS p FROM lists) GROUP BY id)
""", "lists", "item_genres")
def _(spark, folder):
    near = content.content_neighbours(basic(spark, folder), 10)
    out = content.list_diversity(near, tables.items(spark, folder))
    return rounded(out, "average_genre_entropy", "genre_coverage")


# ---- evaluation on 30 % of every user's ratings

cte("strat30", """
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(user_id || '_' || item_id), item_id)
          <= ceil(count(*) OVER (PARTITION BY user_id) * CAST(0.3 AS DOUBLE)) AS is_test
FROM ratings WHERE user_id IN (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= 5)
""", "ratings")
cte("train30", "SELECT * FROM strat30 WHERE NOT is_test", "strat30")
cte("test30", "SELECT * FROM strat30 WHERE is_test", "strat30")
profile_cte("profiles30", "train30", "basic_vectors", SIMPLE)
profile_cte("emphatic30", "train30", "enhanced_vectors", EMPHATIC)


def content_errors_sql(profiles: str, vectors: str, rating: str) -> str:
    return f"""
SELECT {ERRORS}, round(corr(predicted, rating), 6) AS correlation FROM (
  SELECT t.rating, {rating} AS predicted FROM test30 t JOIN (
    SELECT t.user_id, t.item_id, sum(p.val * v.val) / (any_value(a.norm) * any_value(b.norm)) AS s
    FROM test30 t JOIN {vectors} v ON v.id = t.item_id JOIN {profiles} p ON p.user_id = t.user_id AND p.feature = v.feature
    JOIN (SELECT user_id, sqrt(sum(val * val)) AS norm FROM {profiles} GROUP BY user_id) a ON a.user_id = t.user_id
    JOIN (SELECT id, sqrt(sum(val * val)) AS norm FROM {vectors} GROUP BY id) b ON b.id = t.item_id
    GROUP BY t.user_id, t.item_id) x ON x.user_id = t.user_id AND x.item_id = t.item_id)
"""


def content_errors(spark, folder, vectors, weight, to_rating):
    ratings = tables.ratings(spark, folder)
    enough = ratings.groupBy("user_id").count().where("count >= 5")
    split = splits.stratified_split(ratings.join(enough, "user_id", "left_semi"), 0.3)
    train, test = splits.train_test(materialize(split, "split"))
    profiles = materialize(content.user_profiles(train, vectors, weight), "profiles")
    scored = content.profile_similarity(test, profiles, vectors)
    scored = scored.withColumn("predicted", to_rating(F.col("similarity")))
    correlation = evaluation.prediction_correlation(scored).scalar()
    return rounded(evaluation.rating_errors(scored).withColumn("correlation", correlation), "rmse", "mae", "correlation")


@query("j8_content_errors", content_errors_sql("profiles30", "basic_vectors", "1 + 4 * s"), "test30", "profiles30", "basic_vectors")
def _(spark, folder):
    return content_errors(spark, folder, basic(spark, folder), content.simple_weight, scores.linear_rating)


@query("j8_enhanced_errors", content_errors_sql("emphatic30", "enhanced_vectors", "1 + 4 / (1 + exp(-5 * (s - 0.5)))"), "test30", "emphatic30", "enhanced_vectors")
def _(spark, folder):
    return content_errors(spark, folder, enhanced(spark, folder), content.emphatic_weight, scores.sigmoid_rating)
