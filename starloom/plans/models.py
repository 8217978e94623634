"""Files, stored models and matrix factorisation."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from starloom import schemas
from starloom.operators import collaborative as cf, evaluation, factors, profile
from starloom.plans.base import Group, rounded
from starloom.plans.catalogue import HIGH, SUFFICIENT, stats_items
from starloom.plans.collaborative import K, N, named, split_ratings, train_mean, train_recommendations
from starloom.session import materialize, scratch_path, shared_folder
from starloom.sources import files, tables

group = Group()
query, QUERIES, ORACLES = group.query, group.queries, group.oracles

RANK = 10


@query("a1_delimited_files", """
SELECT item_id AS "MovieID", title AS "Title", genres_text AS "Genres", year FROM items
""", "items")
def _(spark, folder):
    path = scratch_path(spark, "movies.dat")
    raw = tables.raw_items(spark, folder).select("item_id", "title", "genres_text")
    files.write_delimited(raw, path)
    movies = files.read_delimited(spark, path, schemas.MOVIES_FILE, "UTF-8")
    clean = tables.clean_items(movies.toDF("item_id", "title", "genres_text"))
    return clean.select(
        F.col("item_id").cast("bigint").alias("MovieID"), F.col("title").alias("Title"),
        F.col("genres_text").alias("Genres"), "year",
    )


@query("a2_ratings_csv", """
SELECT user_id AS "UserID", item_id AS "MovieID", round(rating, 6) AS "Rating", CAST(epoch(ts) AS BIGINT) AS "Timestamp" FROM ratings
""", "ratings")
def _(spark, folder):
    path = scratch_path(spark, "ratings.csv")
    files.export_ratings(tables.ratings(spark, folder), path)
    read = files.read_ratings_csv(spark, [f"{shared_folder(spark)}/absent.csv", path])
    return rounded(read.withColumns({c: F.col(c).cast("bigint") for c in ("UserID", "MovieID")}), "Rating")


@query("a3_a4_catalogue_json", """
SELECT item_id AS "MovieID", title AS "Title", year AS "Year", clean_title AS "CleanTitle", array_to_string(genres, '|') AS "GenreList" FROM items
""", "items")
def _(spark, folder):
    path = scratch_path(spark, "movies.json")
    files.export_catalogue(tables.items(spark, folder), path)
    read = files.read_records(spark, [path], schemas.CATALOGUE_FILE, one_array=False)
    return read.select("MovieID", "Title", "Year", "CleanTitle", F.array_join("GenreList", "|").alias("GenreList"))


@query("a3_array_json", """
SELECT item_id AS "MovieID", title AS "Title", year AS "Year", array_to_string(genres, '|') AS "GenreList" FROM items
""", "items")
def _(spark, folder):
    path = scratch_path(spark, "arrays.json")
    files.export_arrays(tables.items(spark, folder), path)
    read = files.read_records(spark, [path], schemas.CATALOGUE_FILE)
    return read.select("MovieID", "Title", "Year", F.array_join("GenreList", "|").alias("GenreList"))


@query("a4_summary_json", f"""
SELECT count(*) AS total_items, count_if(rating_count >= {SUFFICIENT}) AS items_with_sufficient_ratings, min(year) AS min_year FROM stats_items
""", "stats_items")
def _(spark, folder):
    path = scratch_path(spark, "summary.json")
    summary = profile.quality_summary(stats_items(spark, folder), SUFFICIENT, HIGH)
    files.export_summary(summary, path)
    return spark.read.schema(summary.schema).json(path).select("total_items", "items_with_sufficient_ratings", "min_year")


@query("a5_stored_model", "SELECT id, count(*) AS neighbours, round(sum(score), 6) AS total FROM item_top_ratings GROUP BY id", "item_top_ratings")
def _(spark, folder):
    path = scratch_path(spark, "model")
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    files.save_model(path, {
        "item_neighbours": cf.neighbours(ratings, "item_id", 50),
        "item_means": ratings.groupBy("item_id").agg(F.avg("rating").alias("item_mean")),
    })
    model = files.load_model(spark, path, ["item_neighbours", "item_means"])
    known = model["item_neighbours"].join(model["item_means"], F.col("id") == F.col("item_id"), "left_semi")
    out = known.groupBy("id").agg(F.count("*").alias("neighbours"), F.sum("score").alias("total"))
    return rounded(out, "total")


@query("a6_required_tables", """
SELECT 'ratings' AS name, TRUE AS present, '' AS problem UNION ALL SELECT 'absent', FALSE, 'not found'
""")
def _(spark, folder):
    path = scratch_path(spark, "required")
    files.save_model(path, {"ratings": tables.ratings(spark, folder)})
    found = files.presence(spark, [f"{path}/ratings", f"{path}/absent"], schemas.RATINGS)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "present", "problem")


@query("a7_table_structure", """
SELECT 0 AS position, 'user_id' AS "column", 'bigint' AS type, count_if(user_id IS NULL) AS nulls, count(*) AS rows FROM ratings
UNION ALL SELECT 1, 'item_id', 'bigint', count_if(item_id IS NULL), count(*) FROM ratings
UNION ALL SELECT 2, 'rating', 'double', count_if(rating IS NULL), count(*) FROM ratings
UNION ALL SELECT 3, 'ts', 'timestamp_ntz', count_if(ts IS NULL), count(*) FROM ratings
""", "ratings")
def _(spark, folder):
    return files.structure(tables.ratings(spark, folder))


@query("d5_neighbour_ratings", """
SELECT t.user_id, t.item_id, count(*) AS reached, round(sum(n.score), 6) AS weight
FROM test t JOIN item_top_train n ON n.id = t.item_id JOIN train r ON r.user_id = t.user_id AND r.item_id = n.other
GROUP BY t.user_id, t.item_id
""", "test", "train", "item_top_train")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    reached = cf.reached_by_item(test, cf.neighbours(train, "item_id", 50), train)
    out = reached.groupBy("user_id", "item_id").agg(F.count("*").alias("reached"), F.sum("score").alias("weight"))
    return rounded(out, "weight")


@query("d6_aligned_cells", """
SELECT r.user_id, r.item_id, coalesce(a.rating, 0) AS train_rating, coalesce(b.rating, 0) AS test_rating
FROM ratings r LEFT JOIN train a ON a.user_id = r.user_id AND a.item_id = r.item_id LEFT JOIN test b ON b.user_id = r.user_id AND b.item_id = r.item_id
""", "ratings", "train", "test")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    return cf.aligned(tables.ratings(spark, folder), train, test)


# ---- factorisation

def svd(spark, folder):
    train, test = split_ratings(spark, folder)
    return train, test, *factors.truncated_svd(train, RANK, oversample=6, rounds=3)


# a factorisation has no SQL twin, so these entries return what must hold of its results

@query("f10_e11_explained_variance", f"""
SELECT unnest(range(1, {RANK + 1})) AS component, TRUE AS is_unit, TRUE AS is_stretch, TRUE AS is_share, TRUE AS is_ordered, TRUE AS is_cumulative
""")
def _(spark, folder):
    """Per component: unit item factors, user factors at least as long as the singular value
    (the subspace iteration finds it from below), shares in falling order that add up."""
    train, _, item_factors, singular = svd(spark, folder)
    squares = lambda df: df.select(F.posexplode("f").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x") * F.col("x")).alias("square"))
    items = squares(item_factors).select("at", F.col("square").alias("item_square"))
    users = squares(factors.user_factors(train, item_factors)).select("at", F.col("square").alias("user_square"))
    parts = factors.explained_variance(train, item_factors, RANK).withColumn("at", F.col("component") - 1)
    known = F.element_at(F.array(*[F.lit(s) for s in singular]), F.col("component"))
    in_order = Window.orderBy("component")  # as many rows as the rank
    return parts.join(items, "at").join(users, "at").select(
        "component",
        (F.abs(F.col("item_square") - 1) < 1e-6).alias("is_unit"),
        (F.sqrt("user_square") >= known * (1 - 1e-9)).alias("is_stretch"),
        F.col("ratio").between(0.0, 1.0).alias("is_share"),
        (known <= F.coalesce(F.lag(known).over(in_order), known)).alias("is_ordered"),
        ((F.abs(F.sum("ratio").over(in_order) - F.col("cumulative")) < 1e-9) & (F.col("cumulative") <= 1)).alias("is_cumulative"),
    )


@query("f11_svd_predictions", """
SELECT user_id, item_id, rating, TRUE AS in_scale,
       user_id NOT IN (SELECT user_id FROM train) OR item_id NOT IN (SELECT item_id FROM train) AS is_default FROM test
""", "train", "test")
def _(spark, folder):
    train, test, item_factors, _ = svd(spark, folder)
    mean = train_mean(train)
    out = factors.predict_svd(test, train, item_factors, mean)
    is_default = F.abs(F.col("predicted") - mean) < 1e-12
    return out.select("user_id", "item_id", "rating", F.col("predicted").between(1.0, 5.0).alias("in_scale"), is_default.alias("is_default"))


@query("f12_als_errors", "SELECT model, CASE model WHEN 'als' THEN TRUE END AS beats_mean, count(*) AS n FROM train CROSS JOIN (VALUES ('als'), ('mean')) m(model) GROUP BY model", "train")
def _(spark, folder):
    train, _ = split_ratings(spark, folder)
    mean = train_mean(train)
    scored = materialize(factors.predict_als(train, factors.als_model(train, RANK, 5), mean).select("rating", "predicted"), "scored")
    both = scored.withColumn("model", F.lit("als")).unionByName(scored.select(F.lit("mean").alias("model"), "rating", mean.alias("predicted")))
    errors = evaluation.rating_errors(both, "model")
    least = errors.where("model = 'mean'").select("rmse").scalar()
    return errors.select("model", F.when(F.col("model") == "als", F.col("rmse") < least).alias("beats_mean"), "n")


@query("j7_svd_errors", "SELECT count(*) AS n, TRUE AS beats_zero FROM test", "test")
def _(spark, folder):
    train, test, item_factors, _ = svd(spark, folder)
    scored = materialize(factors.predict_svd(test, train, item_factors, train_mean(train)).select("rating", "predicted"), "scored")
    zero = evaluation.rating_errors(scored.withColumn("predicted", F.lit(0.0))).select("rmse").scalar()
    return evaluation.rating_errors(scored).select("n", (F.col("rmse") < zero).alias("beats_zero"))


# the errors on the held-out rows have no SQL twin, and none is registered for them

def held_out_errors(name, scored, mean):
    """Errors of a model and of the training mean on the test rows, and whether the model's are less."""
    scored = materialize(scored.select("rating", "predicted"), "scored")
    both = scored.withColumn("model", F.lit(name)).unionByName(scored.select(F.lit("mean").alias("model"), "rating", mean.alias("predicted")))
    errors = evaluation.rating_errors(both, "model")
    least = errors.where("model = 'mean'").select("rmse").scalar()
    beats = F.when(F.col("model") == name, F.col("rmse") < least).alias("beats_mean")
    return rounded(errors.select("model", "rmse", "mae", beats, "n"), "rmse", "mae")


@query("f12_als_test_errors")
def _(spark, folder):
    train, test = split_ratings(spark, folder)
    mean = train_mean(train)
    return held_out_errors("als", factors.predict_als(test, factors.als_model(train, RANK, 5), mean), mean)


@query("j7_svd_test_errors")
def _(spark, folder):
    train, test, item_factors, _ = svd(spark, folder)
    mean = train_mean(train)
    return held_out_errors("svd", factors.predict_svd(test, train, item_factors, mean), mean)


# lists by the reconstructed rating, beside those of the neighbourhood models; tests compare them with plain rankings

@query("f13_three_model_ensemble")
def _(spark, folder):
    ratings = materialize(tables.ratings(spark, folder), "ratings")
    item_factors, _ = factors.truncated_svd(ratings, RANK, oversample=6, rounds=3)
    models = {
        "item_knn": cf.item_candidates(cf.neighbours(ratings, "item_id", K), ratings),
        "user_knn": cf.user_candidates(cf.neighbours(ratings, "user_id", K), ratings),
    }
    best = factors.ensemble(models, ratings, item_factors, N)
    return rounded(best.select("user_id", "item_id", *models, "svd", "average_prediction", "rank"), *models, "svd", "average_prediction")


def all_recommendations(spark, folder):
    """Stored lists of the neighbourhood models and the factorisation, and the test rows."""
    near, test = train_recommendations(spark, folder)
    train, _, item_factors, _ = svd(spark, folder)
    lists = named({"svd": factors.svd_recommendations(train, item_factors, 20)})
    return materialize(near.unionByName(lists), "recs"), test


@query("j2_j3_all_models_per_user")
def _(spark, folder):
    return rounded(evaluation.ranking_per_user(*all_recommendations(spark, folder)), "precision", "recall")


@query("j4_all_models_summary")
def _(spark, folder):
    """Averages per model and cut-off, with the catalogue coverage and the metrics that the model leads there."""
    recs, test = all_recommendations(spark, folder)
    summary = materialize(evaluation.ranking_summary(evaluation.ranking_per_user(recs, test)), "summary")
    leads = evaluation.best_models(summary).groupBy("model", "k").agg(F.array_sort(F.collect_list("metric")).alias("leads"))  # four metrics
    covered = evaluation.coverage(recs, tables.items(spark, folder))
    out = summary.join(covered, ["model", "k"]).join(leads, ["model", "k"], "left").withColumn("leads", F.array_join("leads", ","))
    return rounded(out, "precision", "recall", "hit_rate", "f1", "coverage")


@query("j7_all_models_errors")
def _(spark, folder):
    train, test, item_factors, _ = svd(spark, folder)
    mean = train_mean(train)
    models = {
        "item_knn": cf.predict_by_item(test, cf.neighbours(train, "item_id", K), train, mean),
        "user_knn": cf.predict_by_user(test, cf.neighbours(train, "user_id", K), train, mean),
        "svd": factors.predict_svd(test, train, item_factors, mean),
        "als": factors.predict_als(test, factors.als_model(train, RANK, 5), mean),
        "bias": cf.bias_baseline(train, test),
    }
    scored = None
    for name, df in models.items():
        part = df.select(F.lit(name).alias("model"), "rating", "predicted")
        scored = part if scored is None else scored.unionByName(part)
    return rounded(evaluation.rating_errors(scored, "model"), "rmse", "mae")
