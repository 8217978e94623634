"""Queries over titles, statistics, selection and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import scores, titles
from starloom.operators import catalog, profile
from starloom.plans.oracle import cte, sql
from starloom.session import materialize
from starloom.sources import tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, *needs: str):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = sql(oracle, *needs)
        return fn

    return add


# scaled-down thresholds for the thin synthetic catalogue
POOL, RELAXED, SUFFICIENT, HIGH = 40, 30, 30, 40
FALLBACK_AVG, FALLBACK_COUNT = 3.3, 30
SKETCH_ERROR = 0.02
# every item is rated and every genre has a weight, so these leave something to find
TOP_RATING, SURE_WEIGHT = 5.0, 0.9


def stats_items(spark, folder):
    items, ratings = tables.items(spark, folder), tables.ratings(spark, folder)
    return profile.with_stats(items, profile.item_stats(ratings))


def initial_items(spark, folder, dedupe=False):
    stats = materialize(stats_items(spark, folder), "stats")
    return catalog.initial_selection(stats, catalog.frequent_genres(stats, 8), 30, POOL, RELAXED, dedupe)


cte("item_stats", """
SELECT item_id, n AS rating_count, CAST(round_even(round(avg_raw, 9), 3) AS DOUBLE) AS avg_rating,
       CAST(round_even(round(std_raw, 9), 3) AS DOUBLE) AS rating_std, users AS unique_users
FROM item_stats_raw
""", "item_stats_raw")
cte("stats_items", """
SELECT i.*, coalesce(s.rating_count, 0) AS rating_count, s.avg_rating, s.rating_std, s.unique_users
FROM items i LEFT JOIN item_stats s USING (item_id)
""", "items", "item_stats")
cte("year_span", "SELECT min(year) AS first, max(year) AS last FROM items", "items")
cte("target_genres", """
SELECT genre, row_number() OVER (ORDER BY count(*) DESC, genre) AS pos
FROM item_genres GROUP BY genre ORDER BY pos LIMIT 8
""", "item_genres")
cte("pool", f"""
SELECT * FROM stats_items WHERE rating_count >= CASE WHEN
  (SELECT count(*) FROM stats_items WHERE rating_count >= {POOL}) >= 30 THEN {POOL} ELSE {RELAXED} END
""", "stats_items")
cte("genre_picks", """
SELECT item_id, genre FROM (
  SELECT p.item_id, g.genre, row_number() OVER (PARTITION BY g.genre ORDER BY p.rating_count DESC, p.item_id) AS rn
  FROM pool p JOIN (SELECT DISTINCT item_id, genre FROM item_genres) g USING (item_id)
  WHERE g.genre IN (SELECT genre FROM target_genres))
WHERE rn <= 3
""", "pool", "item_genres", "target_genres")
for _name, _used in (("initial_ids", "count(*)"), ("initial_ids_distinct", "count(DISTINCT item_id)")):
    cte(_name, f"""
SELECT DISTINCT item_id FROM genre_picks
UNION
SELECT item_id FROM (
  SELECT item_id, row_number() OVER (ORDER BY rating_count DESC, item_id) AS rn
  FROM pool WHERE item_id NOT IN (SELECT item_id FROM genre_picks))
WHERE rn <= 30 - (SELECT {_used} FROM genre_picks)
""", "pool", "genre_picks")
cte("genre_weights", """
SELECT genre, items, raw / max(raw) OVER () AS importance FROM (
  SELECT genre, count(*) AS items, avg(avg_raw) / 5 * ln(1 + avg(n)) * ln(1 + count(*)) AS raw
  FROM item_genres JOIN item_stats_raw USING (item_id) GROUP BY genre)
""", "item_genres", "item_stats_raw")
cte("fallback", f"""
SELECT item_id, CAST(round_even(round(avg_raw, 9), 2) AS DOUBLE) AS avg_rating, n AS rating_count
FROM item_stats_raw WHERE n >= {FALLBACK_COUNT} AND round_even(round(avg_raw, 9), 2) >= {FALLBACK_AVG}
ORDER BY avg_rating DESC, rating_count DESC, item_id LIMIT 50
""", "item_stats_raw")


# ---- titles and scalar expressions

@query("b1_release_year", "SELECT item_id, title, year FROM items", "items")
def _(spark, folder):
    return tables.items(spark, folder).select("item_id", "title", "year")


@query("b2_clean_title", "SELECT item_id, clean_title FROM items", "items")
def _(spark, folder):
    return tables.items(spark, folder).select("item_id", "clean_title")


@query("b3_genre_list", "SELECT item_id, array_to_string(genres, ';') AS genres, CAST(len(genres) AS INTEGER) AS n FROM items", "items")
def _(spark, folder):
    return tables.items(spark, folder).select("item_id", F.array_join("genres", ";").alias("genres"), F.size("genres").alias("n"))


@query("b4_web_text", """
SELECT doc_id, replace(replace(text, '"', '&quot;'), '''', '&#39;') AS web_text FROM documents
""")
def _(spark, folder):
    docs = tables.table(spark, folder, "documents")
    return docs.select("doc_id", titles.web_title(F.col("text")).alias("web_text"))


@query("b5_b6_decade_and_era", """
SELECT item_id, CAST(floor(year / 10) * 10 AS INTEGER) AS decade,
       CASE WHEN year < 1960 THEN 'Classic' WHEN year < 1980 THEN 'Retro' WHEN year < 1990 THEN 'Eighties'
            WHEN year < 2000 THEN 'Nineties' ELSE 'Modern' END AS era
FROM items
""", "items")
def _(spark, folder):
    year = F.col("year")
    return tables.items(spark, folder).select("item_id", titles.decade(year).alias("decade"), titles.era(year).alias("era"))


@query("b7_b12_year_weights", """
SELECT item_id, round((year - first) / CAST(last - first AS DOUBLE), 6) AS year_normalized,
       round(0.5 + 0.5 * (year - first) / CAST(last - first AS DOUBLE), 6) AS temporal_weight
FROM items, year_span
""", "items", "year_span")
def _(spark, folder):
    df = catalog.with_year_features(tables.items(spark, folder))
    return df.select("item_id", F.round("year_normalized", 6).alias("year_normalized"), F.round("temporal_weight", 6).alias("temporal_weight"))


@query("b8_b9_popularity_quality_reliability", """
SELECT item_id, round(ln(1 + rating_count), 6) AS popularity, round(avg_rating * ln(1 + rating_count), 6) AS quality,
       round(1 / (1 + coalesce(rating_std, 0)), 6) AS reliability,
       round(unique_users / CAST(greatest(rating_count, 1) AS DOUBLE), 6) AS engagement
FROM item_stats
""", "item_stats")
def _(spark, folder):
    stats = profile.item_stats(tables.ratings(spark, folder))
    n, avg = F.col("rating_count"), F.col("avg_rating")
    return stats.select(
        "item_id",
        F.round(scores.popularity(n), 6).alias("popularity"),
        F.round(scores.quality(avg, n), 6).alias("quality"),
        F.round(scores.reliability(F.coalesce("rating_std", F.lit(0.0))), 6).alias("reliability"),
        F.round(scores.engagement(F.col("unique_users"), n), 6).alias("engagement"),
    )


@query("b10_b11_genre_and_title_shape", r"""
SELECT item_id, CAST(len(genres) AS INTEGER) AS genre_count,
       CASE WHEN len(genres) = 0 THEN 0.0 ELSE round(len(list_distinct(genres)) / CAST(len(genres) AS DOUBLE), 6) END AS genre_diversity,
       CAST(length(clean_title) AS INTEGER) AS title_length,
       CAST(CASE WHEN clean_title = '' THEN 0 ELSE len(regexp_split_to_array(clean_title, '\s+')) END AS INTEGER) AS title_words
FROM items
""", "items")
def _(spark, folder):
    genres, title = F.col("genres"), F.col("clean_title")
    diversity = F.when(F.size(genres) == 0, 0.0).otherwise(F.size(F.array_distinct(genres)) / F.size(genres))
    return tables.items(spark, folder).select(
        "item_id",
        F.size(genres).alias("genre_count"),
        F.round(diversity, 6).alias("genre_diversity"),
        titles.title_length(title).alias("title_length"),
        titles.word_count(title).alias("title_words"),
    )


@query("b11_text_word_count", r"""
SELECT doc_id, CAST(length(text) AS INTEGER) AS chars,
       CAST(CASE WHEN regexp_replace(text, '^\s+|\s+$', '', 'g') = '' THEN 0
            ELSE len(regexp_split_to_array(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')) END AS INTEGER) AS words
FROM documents
""")
def _(spark, folder):
    docs = tables.table(spark, folder, "documents")
    return docs.select("doc_id", titles.title_length(F.col("text")).alias("chars"), titles.word_count(F.col("text")).alias("words"))


@query("b13_b17_rating_maps", """
SELECT vec_id, round(1 + 4 * s, 6) AS linear, round(1 + 4 / (1 + exp(-5 * (s - 0.5))), 6) AS sigmoid,
       round(least(5, greatest(1, 3 + 2 * s)), 6) AS clipped_offset
FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 4 AS s FROM embeddings)
""")
def _(spark, folder):
    s = F.element_at("embedding", 1).cast("double") * 4
    return tables.table(spark, folder, "embeddings").select(
        "vec_id",
        F.round(scores.linear_rating(s), 6).alias("linear"),
        F.round(scores.sigmoid_rating(s), 6).alias("sigmoid"),
        F.round(scores.clip(scores.offset_rating(s)), 6).alias("clipped_offset"),
    )


@query("b14_d2_valid_ratings", """
SELECT user_id, item_id, rating FROM ratings
WHERE item_id IN (SELECT item_id FROM ratings GROUP BY item_id HAVING count(*) >= 30)
""", "ratings")
def _(spark, folder):
    ratings = tables.ratings(spark, folder)
    valid = profile.activity(ratings, "item_id").where(F.col("n") >= 30)
    return ratings.join(valid, "item_id", "left_semi").select("user_id", "item_id", "rating")


@query("b15_search", """
SELECT item_id, clean_title, year FROM items
WHERE contains(lower(clean_title), 'ring') AND len(list_filter(genres, lambda g: lower(g) = 'economy')) > 0 AND year = 1961
ORDER BY item_id LIMIT 20
""", "items")
def _(spark, folder):
    return catalog.search(tables.items(spark, folder), "RING", "Economy", 1961).select("item_id", "clean_title", "year")


@query("b16_lookup", "SELECT item_id, title, year FROM items WHERE item_id = 42", "items")
def _(spark, folder):
    return catalog.lookup(tables.items(spark, folder), 42).select("item_id", "title", "year")


@query("b18_blurb", """
SELECT item_id, 'A ' || CAST(year AS VARCHAR) || ' ' || array_to_string(genres[1:2], ', ') || ' film.' AS blurb FROM items
""", "items")
def _(spark, folder):
    return tables.items(spark, folder).select("item_id", titles.blurb(F.col("year"), F.col("genres")).alias("blurb"))


@query("b19_match_keys", r"""
SELECT item_id, lower(clean_title) || '_' || CAST(year AS VARCHAR) AS match_key,
       trim(replace(replace(CASE WHEN lower(t) LIKE 'the %' THEN substr(t, 5) ELSE t END, ':', ''), '&', 'and')) AS search_title
FROM (SELECT *, replace(replace('The ' || clean_title, ' w', ': w'), ' r', ' & r') AS t FROM items)
""", "items")
def _(spark, folder):
    title = F.concat(F.lit("The "), F.col("clean_title"))
    title = F.replace(F.replace(title, F.lit(" w"), F.lit(": w")), F.lit(" r"), F.lit(" & r"))
    return tables.items(spark, folder).select(
        "item_id",
        titles.match_key(F.col("clean_title"), F.col("year")).alias("match_key"),
        titles.search_title(title).alias("search_title"),
    )


# ---- aggregates

@query("c1_item_stats", "SELECT * FROM item_stats", "item_stats")
def _(spark, folder):
    return profile.item_stats(tables.ratings(spark, folder))


@query("c2_feature_stats", """
SELECT item_id, CAST(round_even(round(avg_raw, 9), 3) AS DOUBLE) AS avg_rating, n AS num_ratings,
       CAST(coalesce(round_even(round(std_raw, 9), 3), 0) AS DOUBLE) AS rating_std,
       CAST(round_even(round(median_raw, 9), 3) AS DOUBLE) AS median_rating, users AS num_users
FROM item_stats_raw
""", "item_stats_raw")
def _(spark, folder):
    return profile.feature_stats(materialize(tables.ratings(spark, folder), "ratings"))


@query("c3_quality_summary", f"""
SELECT count(*) AS total_items, count_if(rating_count > 0) AS items_with_ratings,
       count_if(rating_count >= {SUFFICIENT}) AS items_with_sufficient_ratings,
       count_if(rating_count >= {HIGH}) AS items_with_high_ratings,
       round(avg(rating_count), 6) AS avg_ratings_per_item, CAST(median(rating_count) AS DOUBLE) AS median_ratings_per_item,
       min(year) AS min_year, max(year) AS max_year
FROM stats_items
""", "stats_items")
def _(spark, folder):
    df = profile.quality_summary(stats_items(spark, folder), SUFFICIENT, HIGH)
    return df.withColumn("avg_ratings_per_item", F.round("avg_ratings_per_item", 6))


@query("c4_rating_distribution", "SELECT rating, count(*) AS n FROM ratings GROUP BY rating", "ratings")
def _(spark, folder):
    return profile.rating_distribution(tables.ratings(spark, folder))


@query("c5_genre_distribution", "SELECT genre, count(*) AS n FROM item_genres GROUP BY genre", "item_genres")
def _(spark, folder):
    return profile.genre_distribution(tables.items(spark, folder))


@query("c6_activity", """
SELECT 'user' AS kind, user_id AS id, count(*) AS n FROM ratings GROUP BY user_id
UNION ALL SELECT 'item', item_id, count(*) FROM ratings GROUP BY item_id
""", "ratings")
def _(spark, folder):
    ratings = tables.ratings(spark, folder)
    parts = [
        profile.activity(ratings, column).select(F.lit(kind).alias("kind"), F.col(column).alias("id"), "n")
        for kind, column in (("user", "user_id"), ("item", "item_id"))
    ]
    return parts[0].unionByName(parts[1])


@query("c7_serving_stats", """
SELECT item_id, clean_title, coalesce(CAST(round_even(round(avg_raw, 9), 1) AS DOUBLE), 3.5) AS average_rating, coalesce(n, 0) AS rating_count
FROM items LEFT JOIN item_stats_raw USING (item_id)
""", "items", "item_stats_raw")
def _(spark, folder):
    df = profile.serving_stats(tables.items(spark, folder), tables.ratings(spark, folder))
    return df.select("item_id", "clean_title", "average_rating", "rating_count")


@query("c8_genre_importance", "SELECT genre, items, round(importance, 6) AS importance FROM genre_weights", "genre_weights")
def _(spark, folder):
    df = catalog.genre_importance(tables.items(spark, folder), tables.ratings(spark, folder))
    return df.withColumn("importance", F.round("importance", 6))


@query("c9_weighted_genre_score", """
SELECT i.item_id, round(sum(coalesce(w.importance, 0)) / count(*), 6) AS weighted_genre_score
FROM item_genres i LEFT JOIN genre_weights w USING (genre) GROUP BY i.item_id
""", "item_genres", "genre_weights")
def _(spark, folder):
    items = tables.items(spark, folder)
    df = catalog.weighted_genre_score(items, catalog.genre_importance(items, tables.ratings(spark, folder)))
    return df.withColumn("weighted_genre_score", F.round("weighted_genre_score", 6))


@query("c10_popularity_percentile", """
SELECT round(quantile_cont(ln(1 + coalesce(rating_count, 0)), 0.8), 6) AS p80 FROM stats_items
""", "stats_items")
def _(spark, folder):
    # distinct counts are at most sqrt(2N), which bounds the exact percentile's state
    df = stats_items(spark, folder)
    return df.agg(F.round(F.percentile(F.log1p("rating_count"), 0.8), 6).alias("p80"))


@query("c13_feature_correlations", """
SELECT a.f AS feature_a, b.f AS feature_b, round(corr(a.v, b.v), 6) AS correlation
FROM (UNPIVOT f ON popularity, quality, year_d, rating_std INTO NAME f VALUE v) a
JOIN (UNPIVOT f ON popularity, quality, year_d, rating_std INTO NAME f VALUE v) b USING (item_id)
GROUP BY a.f, b.f
""".replace("UNPIVOT f ON", """UNPIVOT (SELECT item_id, ln(1 + rating_count) AS popularity, avg_rating * ln(1 + rating_count) AS quality,
  CAST(year AS DOUBLE) AS year_d, rating_std FROM stats_items) ON"""), "stats_items")
def _(spark, folder):
    df = stats_items(spark, folder).select(
        scores.popularity(F.col("rating_count")).alias("popularity"),
        scores.quality(F.col("avg_rating"), F.col("rating_count")).alias("quality"),
        F.col("year").cast("double").alias("year_d"),
        "rating_std",
    )
    out = profile.correlations(df, ["popularity", "quality", "year_d", "rating_std"])
    return out.withColumn("correlation", F.round("correlation", 6))


@query("c14_sparsity", """
SELECT round(1 - count(*) / CAST(count(DISTINCT user_id) * count(DISTINCT item_id) AS DOUBLE), 6) AS sparsity FROM ratings
""", "ratings")
def _(spark, folder):
    return profile.sparsity(tables.ratings(spark, folder)).select(F.round("sparsity", 6).alias("sparsity"))


@query("c16_means", """
SELECT 'all' AS kind, CAST(NULL AS BIGINT) AS id, round(avg(rating), 6) AS mean FROM ratings
UNION ALL SELECT 'user', user_id, round(avg(rating), 6) FROM ratings GROUP BY user_id
UNION ALL SELECT 'item', item_id, round(avg(rating), 6) FROM ratings GROUP BY item_id
""", "ratings")
def _(spark, folder):
    ratings = tables.ratings(spark, folder)
    _, users, items = profile.means(ratings)
    overall = ratings.agg(F.avg("rating").alias("m")).select(F.lit("all").alias("kind"), F.lit(None).cast("bigint").alias("id"), "m")
    users = users.select(F.lit("user"), "user_id", "user_mean")
    items = items.select(F.lit("item"), "item_id", "item_mean")
    return overall.union(users).union(items).select("kind", "id", F.round("m", 6).alias("mean"))


@query("c17_catalogue_summary", """
SELECT count(*) AS total_items, count_if(poster_url IS NOT NULL AND NOT contains(lower(poster_url), 'placeholder')) AS items_with_posters,
       (SELECT count(*) FROM initial_ids) AS initial_items, count(*) > 0 AS data_loaded
FROM (SELECT CASE WHEN n IS NULL THEN NULL WHEN n < 30 THEN 'https://img/Placeholder.png' ELSE 'https://img/' || title END AS poster_url
      FROM items LEFT JOIN item_stats_raw USING (item_id))
""", "items", "initial_ids", "item_stats_raw")
def _(spark, folder):
    rated = profile.activity(tables.ratings(spark, folder), "item_id")
    poster = (
        F.when(F.col("n").isNull(), None)
        .when(F.col("n") < 30, "https://img/Placeholder.png")
        .otherwise(F.concat(F.lit("https://img/"), "title"))
    )
    items = tables.items(spark, folder).join(rated, "item_id", "left").withColumn("poster_url", poster)
    return profile.catalogue_summary(items, initial_items(spark, folder))


@query("c18_rating_shares", """
SELECT rating, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM ratings), 6) AS percentage FROM ratings GROUP BY rating
""", "ratings")
def _(spark, folder):
    df = profile.shares(tables.ratings(spark, folder), "rating")
    return df.withColumn("percentage", F.round("percentage", 6))


@query("c19_approx_users", "SELECT item_id, count(DISTINCT user_id) AS unique_users, TRUE AS is_close FROM ratings GROUP BY item_id", "ratings")
def _(spark, folder):
    # the sketch against the exact count: five deviations, as every item is judged, or two users where the count is small
    ratings = tables.ratings(spark, folder)
    both = profile.approx_users(ratings, SKETCH_ERROR).join(profile.item_stats(ratings).select("item_id", "unique_users"), "item_id")
    error = F.abs(F.col("approx_users") - F.col("unique_users"))
    return both.select("item_id", "unique_users", (error <= F.greatest(F.lit(2.0), 5 * SKETCH_ERROR * F.col("unique_users"))).alias("is_close"))


# ---- joins, selections, checks

@query("d1_items_with_stats", "SELECT item_id, title, year, rating_count, avg_rating, rating_std, unique_users FROM stats_items", "stats_items")
def _(spark, folder):
    return stats_items(spark, folder).select("item_id", "title", "year", "rating_count", "avg_rating", "rating_std", "unique_users")


@query("d3_unrated_items", f"""
SELECT i.item_id, i.title FROM items i WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.item_id = i.item_id AND r.rating >= {TOP_RATING})
""", "items", "ratings")
def _(spark, folder):
    liked = tables.ratings(spark, folder).where(F.col("rating") >= TOP_RATING)
    return profile.orphans(tables.items(spark, folder), liked, "item_id").select("item_id", "title")


cte("metadata", """
SELECT l_orderkey * 10 + l_linenumber AS meta_id, p.p_name AS search_title, year(max(l_shipdate)) - 40 AS release_year,
       l_orderkey AS position
FROM lineitem JOIN part p ON l_partkey = p_partkey GROUP BY l_orderkey, l_linenumber, p.p_name
""")


@query("d10_best_metadata", """
SELECT item_id, tier, meta_id FROM (
  SELECT i.item_id, CASE WHEN abs(m.release_year - i.year) = 0 THEN 0 WHEN abs(m.release_year - i.year) <= 1 THEN 1 ELSE 2 END AS tier, m.meta_id,
         row_number() OVER (PARTITION BY i.item_id ORDER BY
           CASE WHEN abs(m.release_year - i.year) = 0 THEN 0 WHEN abs(m.release_year - i.year) <= 1 THEN 1 ELSE 2 END, m.position, m.meta_id) AS rn
  FROM items i JOIN metadata m ON m.search_title = i.clean_title)
WHERE rn = 1
""", "items", "metadata")
def _(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    names = tables.table(spark, folder, "part").select("p_partkey", "p_name")
    named = lines.join(names, F.col("l_partkey") == F.col("p_partkey"))
    metadata = (
        tables.dealt(named, lines, "l_orderkey", "l_linenumber", "p_name")
        .groupBy("l_orderkey", "l_linenumber", "p_name")
        .agg((F.year(F.max("l_shipdate")) - 40).alias("release_year"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("meta_id"),
            F.col("p_name").alias("search_title"),
            "release_year",
            F.col("l_orderkey").alias("position"),
        )
    )
    return catalog.best_metadata(tables.items(spark, folder), metadata)


@query("d11_referential_integrity", """
SELECT 'sessions' AS source, count(*) AS orphans FROM sessions WHERE item_id NOT IN (SELECT item_id FROM items)
UNION ALL SELECT 'ratings', count(*) FROM ratings WHERE item_id NOT IN (SELECT item_id FROM items)
""", "sessions", "ratings", "items")
def _(spark, folder):
    items = tables.items(spark, folder)
    parts = [
        profile.orphans(df, items, "item_id").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("source"), "orphans")
        for name, df in (("sessions", tables.sessions(spark, folder)), ("ratings", tables.ratings(spark, folder)))
    ]
    return parts[0].unionByName(parts[1])


@query("d12_genre_weight_lookup", f"""
SELECT item_id, genre, round(coalesce(importance, 0.5), 6) AS weight
FROM item_genres LEFT JOIN (SELECT * FROM genre_weights WHERE importance > {SURE_WEIGHT}) USING (genre)
""", "item_genres", "genre_weights")
def _(spark, folder):
    items = tables.items(spark, folder)
    weights = catalog.genre_importance(items, tables.ratings(spark, folder)).where(F.col("importance") > SURE_WEIGHT)
    return (
        items.select("item_id", F.explode("genres").alias("genre"))
        .join(weights, "genre", "left")
        .select("item_id", "genre", F.round(F.coalesce("importance", F.lit(0.5)), 6).alias("weight"))
    )


@query("e3_initial_items", "SELECT item_id, rating_count FROM stats_items WHERE item_id IN (SELECT item_id FROM initial_ids)", "stats_items", "initial_ids")
def _(spark, folder):
    return initial_items(spark, folder).select("item_id", "rating_count")


@query("e3_initial_items_distinct", "SELECT item_id, rating_count FROM stats_items WHERE item_id IN (SELECT item_id FROM initial_ids_distinct)", "stats_items", "initial_ids_distinct")
def _(spark, folder):
    return initial_items(spark, folder, dedupe=True).select("item_id", "rating_count")


@query("e8_fallback_list", "SELECT f.*, title FROM fallback f JOIN items USING (item_id)", "fallback", "items")
def _(spark, folder):
    df = catalog.fallback(tables.ratings(spark, folder), tables.items(spark, folder), FALLBACK_AVG, FALLBACK_COUNT)
    return df.select("item_id", "avg_rating", "rating_count", "title")


@query("e9_most_active", """
SELECT * FROM (SELECT 'item' AS kind, item_id AS id, count(*) AS n FROM ratings GROUP BY item_id ORDER BY n DESC, id LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'user', user_id AS id, count(*) AS n FROM ratings GROUP BY user_id ORDER BY n DESC, id LIMIT 10)
""", "ratings")
def _(spark, folder):
    ratings = tables.ratings(spark, folder)
    top = lambda column, n: profile.activity(ratings, column).orderBy(F.desc("n"), column).limit(n)
    items = top("item_id", 5).select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), "n")
    return items.union(top("user_id", 10).select(F.lit("user"), "user_id", "n"))


@query("s4_distinct_genres", "SELECT DISTINCT genre FROM item_genres", "item_genres")
def _(spark, folder):
    return tables.items(spark, folder).select(F.explode("genres").alias("genre")).distinct()


@query("k1_item_rules", """
SELECT item_id, coalesce(NOT year BETWEEN 1900 AND 2030, TRUE) AS bad_year, NOT coalesce(round_even(round(avg_raw, 9), 1), 3.5) BETWEEN 0 AND 5 AS bad_average,
       coalesce(n, 0) < 0 AS bad_count, NOT length(clean_title) BETWEEN 1 AND 500 AS bad_title, len(genres) = 0 AS no_genre
FROM items LEFT JOIN item_stats_raw USING (item_id)
""", "items", "item_stats_raw")
def _(spark, folder):
    return profile.item_violations(profile.serving_stats(tables.items(spark, folder), tables.ratings(spark, folder)))


@query("k2_request_rules", """
SELECT session_id, count(*) AS n_ratings, count_if(item_id <= 0) AS bad_ids, count_if(NOT rating BETWEEN 1 AND 5) AS bad_ratings,
       count_if(item_id <= 0) = 0 AND count_if(NOT rating BETWEEN 1 AND 5) = 0 AND count(*) >= 15 AS is_valid
FROM session_ratings GROUP BY session_id
""", "session_ratings")
def _(spark, folder):
    latest = tables.latest_session_ratings(tables.sessions(spark, folder))
    return profile.rating_request_checks(latest, "session_id")


@query("k3_dataset_checks", f"""
SELECT 'enough_items' AS "check", (SELECT count(*) FROM items) >= 1000 AS passed
UNION ALL SELECT 'year_range', (SELECT min(year) <= 1960 AND max(year) >= 2000 FROM items)
UNION ALL SELECT 'initial_size', (SELECT count(*) BETWEEN 20 AND 35 FROM initial_ids)
UNION ALL SELECT 'initial_counts', (SELECT count(*) <= 5 FROM stats_items WHERE rating_count < {RELAXED} AND item_id IN (SELECT item_id FROM initial_ids))
UNION ALL SELECT 'enough_ratings', (SELECT count(*) FROM ratings) >= 10000
UNION ALL SELECT 'rating_range', (SELECT min(rating) >= 1 AND max(rating) <= 5 FROM ratings)
UNION ALL SELECT 'no_nulls', (SELECT count(*) = 0 FROM ratings WHERE user_id IS NULL OR item_id IS NULL OR rating IS NULL)
UNION ALL SELECT 'initial_in_catalogue', (SELECT count(*) = 0 FROM initial_ids WHERE item_id NOT IN (SELECT item_id FROM items))
UNION ALL SELECT 'ratings_in_catalogue', (SELECT count(*) = 0 FROM ratings WHERE item_id NOT IN (SELECT item_id FROM items))
UNION ALL SELECT 'initial_genres', (SELECT count(DISTINCT genre) >= 6 FROM item_genres WHERE item_id IN (SELECT item_id FROM initial_ids))
UNION ALL SELECT 'all_genres', (SELECT count(DISTINCT genre) >= 10 FROM item_genres)
""", "items", "initial_ids", "stats_items", "ratings", "item_genres")
def _(spark, folder):
    return profile.dataset_checks(
        tables.items(spark, folder), initial_items(spark, folder), tables.ratings(spark, folder),
        min_items=1000, min_ratings=10000, min_initial_count=RELAXED, year_span=(1960, 2000),
    )
