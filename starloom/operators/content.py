"""Content features of items in long form, similarity and user profiles."""

from __future__ import annotations

import math

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions import scores, titles
from starloom.functions.scores import by_score, clip, top_n
from starloom.operators import asked, blocks, catalog, profile, stored
from starloom.session import materialize

# The token pattern and the scaled columns.
TOKEN = r"[\p{L}\p{N}_]{2,}"
BASIC_NUMERICS = (
    "year_normalized", "avg_rating", "popularity", "quality", "genre_count", "title_length", "title_words",
)
ENHANCED_NUMERICS = (
    "year_normalized", "avg_rating", "popularity", "quality", "genre_count", "title_length",
    "weighted_genre_score", "temporal_weight", "reliability", "engagement", "genre_diversity", "median_rating",
)


def feature_table(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row of engineered features per item; gaps become 0."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    n, avg = F.col("num_ratings"), F.col("avg_rating")
    joined = catalog.with_year_features(items).join(profile.feature_stats(ratings), "item_id", "left")
    filled = joined.withColumns({
        c: zero(c) for c in (
            "year_normalized", "decade", "temporal_weight", "avg_rating", "num_ratings", "rating_std",
            "median_rating", "num_users",
        )
    })
    genres = F.col("genres")
    return filled.withColumns({
        "popularity": scores.popularity(n),
        "quality": scores.quality(avg, n),
        "reliability": scores.reliability(F.col("rating_std")),
        "engagement": scores.engagement(F.col("num_users"), n),
        "genre_count": F.size(genres),
        "genre_diversity": F.when(F.size(genres) == 0, 0.0).otherwise(F.size(F.array_distinct(genres)) / F.size(genres)),
        "title_length": titles.title_length(F.col("clean_title")),
        "title_words": titles.word_count(F.col("clean_title")),
    })


def enhanced_table(items: DataFrame, ratings: DataFrame, importance: DataFrame) -> DataFrame:
    weights = catalog.weighted_genre_score(items, importance)
    return feature_table(items, ratings).join(weights, "item_id")


def plain_text(features: DataFrame) -> DataFrame:
    """``(id, text)``: genres, era and decade."""
    genres = F.replace(F.coalesce("genres_text", F.lit("")), F.lit("|"), F.lit(" "))
    decade = F.concat(F.lit("decade_"), F.col("decade").cast("string"))
    text = titles.strip(F.concat_ws(" ", genres, "era", decade))
    return features.select(F.col("item_id").alias("id"), text.alias("text"))


def weighted_text(features: DataFrame, importance: DataFrame, high: float = 4.0, share: float = 0.8) -> DataFrame:
    """``(id, text)``: genres repeated by importance, era, decade and quality marks."""
    popular = features.agg(F.percentile("popularity", share)).scalar()
    repeats = F.greatest(F.lit(1), F.floor(F.coalesce("importance", F.lit(0.5)) * 3).cast("int"))
    words = (
        features.select("item_id", F.posexplode("genres").alias("pos", "genre"))
        .join(importance.select("genre", "importance"), "genre", "left")
        .groupBy("item_id")
        .agg(F.collect_list(F.struct("pos", F.array_repeat(F.lower("genre"), repeats).alias("words"))).alias("parts"))
    )
    words = words.select("item_id", F.array_join(F.flatten(F.array_sort("parts").getField("words")), " ").alias("genre_words"))
    text = F.concat_ws(
        " ",
        "genre_words",
        F.lower("era"),
        F.concat(F.lit("decade_"), F.col("decade").cast("string")),
        F.when(F.col("avg_rating") > high, "high_quality"),
        F.when(F.col("popularity") > popular, "popular"),
    )
    return features.join(words, "item_id", "left").select(F.col("item_id").alias("id"), text.alias("text"))


def english_stop_words() -> tuple[str, ...]:
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def tokens(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), 1)
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def ngrams(words: Column, longest: int) -> Column:
    """All runs of one to ``longest`` words, joined by a space."""

    def runs_of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.concat(words, *[runs_of(n) for n in range(2, longest + 1)])


def term_counts(texts: DataFrame, longest: int = 2, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """``(id, term, tf)`` of ``(id, text)``."""
    # the generator keeps the optimizer from repeating the tokenising per n-gram
    words = texts.select("id", F.explode(F.array(tokens(F.col("text"), stop_words))).alias("words"))
    terms = words.select("id", F.explode(ngrams(F.col("words"), longest)).alias("term"))
    return terms.groupBy("id", "term").agg(F.count("*").alias("tf"))


def vocabulary(counts: DataFrame, n_docs: Column, min_df: int = 2, max_df: float = 0.8, size: int = 1000) -> DataFrame:
    """``(term, df, feature)``: the ``size`` most frequent terms in range.

    Counts are summed before the shuffle; at most ``size`` rows remain, which
    bounds the window that numbers them.
    """
    terms = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("freq"))
    kept = terms.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    best = kept.orderBy(F.desc("freq"), "term").limit(size)
    return best.select("term", "df", F.row_number().over(Window.orderBy("term")).cast("bigint").alias("feature"))


def tfidf(
    texts: DataFrame,
    longest: int = 2,
    min_df: int = 2,
    max_df: float = 0.8,
    size: int = 1000,
    sublinear: bool = False,
    stop_words: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, feature, term, val)`` with smoothed idf and unit length per text."""
    counts = materialize(term_counts(texts, longest, stop_words), "terms")
    n_docs = texts.agg(F.count("*")).scalar()
    terms = vocabulary(counts, n_docs, min_df, max_df, size)
    idf = F.log((1 + n_docs) / (1 + F.col("df"))) + 1
    tf = 1 + F.log("tf") if sublinear else F.col("tf")
    # the vocabulary holds at most ``size`` rows
    weighted = counts.join(F.broadcast(terms), "term").select("id", "feature", "term", (tf * idf).alias("w"))
    norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, "id").select("id", "feature", "term", (F.col("w") / F.col("norm")).alias("val"))


def _long(features: DataFrame, columns: tuple[str, ...], scaled) -> DataFrame:
    cells = [
        F.struct(F.lit(-1 - i).cast("bigint").alias("feature"), F.lit(c).alias("term"), scaled(c).alias("val"))
        for i, c in enumerate(columns)
    ]
    return features.select(F.col("item_id").alias("id"), F.inline(F.array(*cells)))


def zscores(features: DataFrame, columns: tuple[str, ...] = BASIC_NUMERICS) -> DataFrame:
    """Columns centred and scaled by the population deviation, in long form."""
    stats = features.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ])).scalar()

    def scaled(c: str) -> Column:
        mean, std = stats.getField(c).getField("mean"), stats.getField(c).getField("std")
        return (F.col(c) - mean) / F.when(std == 0, 1.0).otherwise(std)

    return _long(features, columns, scaled)


def minmax(features: DataFrame, columns: tuple[str, ...] = ENHANCED_NUMERICS) -> DataFrame:
    """Columns scaled to [0, 1]; a constant column becomes 0."""
    stats = features.agg(F.struct(*[
        F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c) for c in columns
    ])).scalar()

    def scaled(c: str) -> Column:
        low, high = stats.getField(c).getField("low"), stats.getField(c).getField("high")
        return (F.col(c) - low) / F.when(high == low, 1.0).otherwise(high - low)

    return _long(features, columns, scaled)


def basic_vectors(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """``(id, feature, val)``: tf-idf of the plain text next to z-scores."""
    features = materialize(feature_table(items, ratings), "features")
    text = tfidf(plain_text(features))
    return materialize(text.unionByName(zscores(features)).drop("term"), "vectors")


def enhanced_vectors(items: DataFrame, ratings: DataFrame, text_weight: float = 0.6, numeric_weight: float = 0.4) -> DataFrame:
    """``(id, feature, val)``: weighted tf-idf next to weighted min-max columns."""
    importance = materialize(catalog.genre_importance(items, ratings), "importance")
    features = materialize(enhanced_table(items, ratings, importance), "features")
    text = tfidf(weighted_text(features, importance), longest=3, min_df=1, max_df=0.7, size=2000, sublinear=True)
    text = text.withColumn("val", F.col("val") * text_weight)
    numeric = minmax(features).withColumn("val", F.col("val") * numeric_weight)
    return materialize(text.unionByName(numeric).drop("term"), "vectors")


def as_dims(vectors: DataFrame) -> DataFrame:
    return vectors.select("id", F.col("feature").alias("dim"), "val")


def content_neighbours(vectors: DataFrame, k: int = 10, **options) -> DataFrame:
    """The ``k`` items with the highest feature cosine for every item; block products only if their options are given."""
    if not options:
        return stored.nearest(stored.store(as_dims(vectors), "units"), k=k, min_score=-math.inf)
    units = materialize(blocks.unit(as_dims(vectors)), "units")
    return blocks.nearest(units, k=k, min_score=-math.inf, **options)


def similar_content(vectors: DataFrame, min_score: float, **options) -> DataFrame:
    if not options:
        return stored.nearest(stored.store(as_dims(vectors), "units"), min_score=min_score)
    units = materialize(blocks.unit(as_dims(vectors)), "units")
    return blocks.nearest(units, min_score=min_score, **options)


def blended_neighbours(vectors: DataFrame, k: int = 10, cosine: float = 0.7, pearson: float = 0.3, **options) -> DataFrame:
    """Neighbours by a blend of cosine and Pearson correlation of the features.

    With D features, means m and centred lengths s, Pearson is
    ``(a.b - D ma mb) / (sa sb)``, so the blend is a dot product of longer
    vectors: the cosine part, the Pearson part, and one dimension that carries
    the means with opposite signs on the two sides.
    """
    d = vectors.agg(F.countDistinct("feature").alias("d")).scalar().cast("double")
    x = F.col("val")
    sums = vectors.groupBy("id").agg(F.sum(x * x).alias("sq"), F.sum(x).alias("sum")).select(
        "id",
        F.sqrt("sq").alias("norm"),
        (F.col("sum") / d).alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), F.col("sq") - F.col("sum") * F.col("sum") / d)).alias("spread"),
    )
    sums = materialize(sums, "sums")
    scaled = vectors.join(sums, "id")
    # the features of the two parts alternate; no feature is as low as the place of the means
    parts = scaled.where("norm > 0").select(
        "id", (F.col("feature") * 2).alias("dim"), (math.sqrt(cosine) * x / F.col("norm")).alias("val")
    ).unionByName(scaled.where("spread > 1e-12").select(
        "id", (F.col("feature") * 2 + 1).alias("dim"), (math.sqrt(pearson) * x / F.col("spread")).alias("val")
    ))
    means = sums.where("spread > 1e-12").select(
        "id", F.lit(-(1 << 31)).cast("bigint").alias("dim"), (F.sqrt(pearson * d) * F.col("mean") / F.col("spread")).alias("val")
    )
    parts = materialize(parts, "parts")
    left = parts.unionByName(means)
    right = parts.unionByName(means.withColumn("val", -F.col("val")))
    if not options:
        return stored.nearest(stored.store(left, "left", False), stored.store(right, "right", False), k=k, min_score=-math.inf)
    itself = sums.select("id", F.col("id").alias("other"))
    return blocks.nearest(left, right, k=k, min_score=-math.inf, exclude=itself, **options)


def simple_weight(rating: Column) -> Column:
    return rating / 5


def emphatic_weight(rating: Column) -> Column:
    """Squares the weight of liked items."""
    return F.when(rating >= 4, (rating / 5) * (rating / 5)).otherwise(rating / 5)


def user_profiles(ratings: DataFrame, vectors: DataFrame, weight=simple_weight) -> DataFrame:
    """``(user_id, feature, val)``: rating-weighted mean of the rated items' features.

    An item without a feature adds 0 to it, so the total weight is per user.
    """
    w = weight(F.col("rating"))
    known = ratings.join(vectors.select(F.col("id").alias("item_id")).distinct(), "item_id", "left_semi")
    totals = known.groupBy("user_id").agg(F.sum(w).alias("total"))
    # a strip of users sums the vectors of its items in one task: ratings times features are not shuffled
    sums = asked.weighted_sums(as_dims(vectors), known.select("user_id", "item_id", w.alias("rating"))).withColumnRenamed("dim", "feature")
    return sums.join(totals.where("total > 0"), "user_id").select(
        "user_id", "feature", (F.col("sum") / F.col("total")).alias("val")
    )


def recommend_by_profile(ratings: DataFrame, vectors: DataFrame, n: int = 10, weight=simple_weight, **options) -> DataFrame:
    """The ``n`` unrated items closest to each user's profile."""
    if not options:
        w = weight(F.col("rating"))
        known = ratings.join(vectors.select(F.col("id").alias("item_id")).distinct(), "item_id", "left_semi")
        counted = known.groupBy("user_id").agg(F.sum(w).alias("total")).where("total > 0")
        weights = known.join(counted, "user_id", "left_semi").select("user_id", "item_id", w.alias("rating"))
        # of one length, a profile is the same whether it is a sum or a mean
        profiles = asked.weighted_blocks(as_dims(vectors), weights, "profiles")
        best = stored.nearest(profiles, stored.store(as_dims(vectors), "units"), k=n, min_score=-math.inf, itself=True)
        return best.select(F.col("id").alias("user_id"), F.col("other").alias("item_id"), "score", "rank")
    profiles = user_profiles(ratings, vectors, weight).select(
        F.col("user_id").alias("id"), F.col("feature").alias("dim"), "val"
    )
    users = materialize(blocks.unit(profiles), "profiles")
    items = materialize(blocks.unit(as_dims(vectors)), "units")
    rated = ratings.select(F.col("user_id").alias("id"), F.col("item_id").alias("other"))
    best = blocks.nearest(users, items, k=n, min_score=-math.inf, exclude=rated, **options)
    return best.select(F.col("id").alias("user_id"), F.col("other").alias("item_id"), "score", "rank")


def profile_similarity(targets: DataFrame, profiles: DataFrame, vectors: DataFrame) -> DataFrame:
    """Cosine of the user's profile and the item for given targets."""
    length = lambda df, key: df.groupBy(key).agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias(f"{key}_norm"))
    items = vectors.withColumnRenamed("id", "item_id")
    dots = (
        targets.select("user_id", "item_id")
        .join(items.withColumnRenamed("val", "x"), "item_id")
        .join(profiles, ["user_id", "feature"])
        .groupBy("user_id", "item_id")
        .agg(F.sum(F.col("x") * F.col("val")).alias("dot"))
    )
    return (
        targets.join(dots, ["user_id", "item_id"])
        .join(length(profiles, "user_id"), "user_id")
        .join(length(items, "item_id"), "item_id")
        .withColumn("similarity", F.col("dot") / (F.col("user_id_norm") * F.col("item_id_norm")))
        .drop("dot", "user_id_norm", "item_id_norm")
    )


def predict_by_liked(targets: DataFrame, ratings: DataFrame, vectors: DataFrame, like: float = 4.0, **options) -> DataFrame:
    """``3 + 2 * mean(similarity * rating)`` over the user's liked items.

    A target the user liked is left out of its own mean.
    """
    liked = ratings.where(F.col("rating") >= like).select("user_id", "item_id", "rating")
    units = materialize(blocks.unit(as_dims(vectors)), "units")
    score = blocks.weighted_scores if options else asked.weighted_scores
    sums = score(units, liked, targets, **options).select("user_id", "item_id", "num")
    sizes = liked.groupBy("user_id").agg(F.count("*").alias("n_liked"))
    own = liked.select("user_id", "item_id", F.lit(1).alias("own"))
    keys = ["user_id", "item_id"]
    joined = targets.join(sums, keys, "left").join(sizes, "user_id", "left").join(own, keys, "left")
    others = F.nullif(F.coalesce("n_liked", F.lit(0)) - F.coalesce("own", F.lit(0)), F.lit(0))
    mean = F.coalesce("num", F.lit(0.0)) / others
    predicted = F.coalesce(clip(scores.offset_rating(mean)), F.lit(3.0))
    return joined.withColumn("predicted", predicted).drop("num", "n_liked", "own")


def list_diversity(neighbours: DataFrame, items: DataFrame) -> DataFrame:
    """Genre coverage of all lists and the mean entropy of a list's genres."""
    genres = items.select(F.col("item_id").alias("other"), F.explode("genres").alias("genre"))
    counts = neighbours.select("id", "other").join(genres, "other").groupBy("id", "genre").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("id"))
    p = F.col("p")
    per_list = counts.withColumn("p", F.col("n") / total).groupBy("id").agg((-F.sum(p * F.log2(p))).alias("entropy"))
    possible = genres.agg(F.countDistinct("genre")).scalar()
    covered = counts.agg(F.countDistinct("genre")).scalar()
    return per_list.agg(F.avg("entropy").alias("average_genre_entropy")).withColumns({
        "covered_genres": covered,
        "possible_genres": possible,
        "genre_coverage": covered / possible,
    })


def recommend_similar(neighbours: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Titles of the ``n`` items most similar to each item."""
    best = top_n(neighbours.drop("rank"), ["id"], n, *by_score("score", "other"))
    return best.join(items.select(F.col("item_id").alias("other"), "title"), "other")
