"""Literal cases for titles, sessions, lists, files and selection."""

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions import titles
from starloom.operators import catalog, profile, serving, sessions
from starloom.session import scratch_path
from starloom.sources import files, tables


def session(spark, ratings, key=1):
    rows = [(key, i, float(r)) for i, r in ratings.items()]
    return spark.createDataFrame(rows, "session_id bigint, item_id bigint, rating double")


def lists(spark, rows):
    return spark.createDataFrame(
        [(u, i, float(p), float(c), k) for u, i, p, c, k in rows],
        "user_id bigint, item_id bigint, predicted double, confidence double, rank int",
    )


def test_title_parts(spark):
    raw = spark.createDataFrame(
        [(1, "Lamp Garden (1995)", "Animation|Children's| Comedy"), (2, 'No "Year"', None)], "item_id bigint, title string, genres_text string"
    )
    a, b = tables.clean_items(raw).orderBy("item_id").collect()
    assert (a["year"], a["clean_title"], a["genres"]) == (1995, "Lamp Garden", ["Animation", "Children's", "Comedy"])
    assert (b["year"], b["genres"], b["web_title"]) == (None, [], "No &quot;Year&quot;")


@pytest.mark.parametrize("title,want", [
    ("The Matrix", "Matrix"), ("Star Wars: Episode IV", "Star Wars Episode IV"), ("Fast & Furious", "Fast and Furious"),
])
def test_search_title(spark, title, want):
    assert spark.range(1).select(titles.search_title(F.lit(title))).first()[0] == want


def test_match_key_and_names(spark):
    row = spark.range(1).select(
        titles.match_key(F.lit("  The Matrix  "), F.lit(1999)),
        titles.names_text(F.array(F.lit("A"), F.lit("B"), F.lit("C"))),
        titles.names_text(F.array(F.lit("A"), F.lit("B"))),
        titles.word_count(F.lit("  ")),
    ).first()
    assert list(row) == ["the matrix_1999", "A, B, and C", "A and B", 0]


def test_rating_patterns(spark):
    row = sessions.rating_patterns(session(spark, {1: 4, 2: 3.5, 3: 5, 4: 2, 5: 4.5})).first()
    assert (row["total_ratings"], row["mean_rating"], row["stars_3"]) == (5, 3.8, 1)
    assert sessions.rating_patterns(session(spark, {i: 4.5 for i in range(1, 21)})).first()["is_generous_rater"]
    assert sessions.rating_patterns(session(spark, {i: 2.0 for i in range(1, 21)})).first()["is_critical_rater"]


def test_confidence_of_a_short_session(spark):
    df = sessions.rating_patterns(session(spark, {1: 4, 2: 5})).select(sessions.confidence("hybrid"))
    assert df.first()[0] == 0.3


def test_validation(spark):
    why = lambda r: tuple(sessions.validate(session(spark, r)).select("is_valid", "reason").first())
    assert why({1: 6.0}) == (False, "Rating must be between 1.0 and 5.0: 6.0")
    assert why({-1: 4.0}) == (False, "Invalid movie ID: -1")
    assert why({i: 4.0 for i in range(1, 21)}) == (False, sessions.SUSPICIOUS)
    assert why({i: 3.0 + i % 2 for i in range(1, 31)}) == (False, sessions.SUSPICIOUS)
    assert why({i * 7: 1.0 + i % 5 for i in range(1, 10)}) == (True, None)


def test_session_key_ignores_order(spark):
    key = lambda r: sessions.session_keys(session(spark, r)).first()["session_key"]
    assert key({1: 4.0, 20: 3.5}) == key({20: 3.5, 1: 4.0}) != key({1: 4.0, 20: 3.0})
    assert len(key({1: 4.0})) == 16


def test_large_session_has_key_and_arrays(spark):
    large = session(spark, {i: 1.0 + i % 5 for i in range(1, 1102)})
    row = sessions.compact(large).first()
    assert len(row["item_ids"]) == len(row["ratings"]) == row["rating_count"] == 1101
    assert len(sessions.session_keys(large).first()["session_key"]) == 16


def test_long_list_keeps_all_rows(spark):
    rows = [(1, i, 5.0 - i / 100, 1, i) for i in range(1, 121)]
    items = spark.createDataFrame([(i, ["a"]) for i in range(1, 121)], "item_id bigint, genres array<string>")
    found = serving.diversify(lists(spark, rows), items).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 121))
    assert all(r["rank"] == r["item_id"] for r in found if r["item_id"] > 100)


def test_delta(spark):
    old = lists(spark, [(1, 1, 4.5, 1, 1), (1, 2, 4.2, 1, 2), (1, 3, 4.0, 1, 3)])
    new = lists(spark, [(1, 1, 4.3, 1, 1), (1, 3, 4.0, 1, 2), (1, 4, 3.9, 1, 3), (2, 1, 4.0, 1, 1), (2, 2, 4.0, 1, 2)])
    a, b = serving.list_delta(old, new).orderBy("user_id").collect()
    assert (a["new_items"], a["removed_items"], a["n_rerated"], a["n_moved"]) == (1, 1, 1, 1)
    assert a["rating_changes"][0]["change"] == -0.2
    assert (b["new_items"], b["removed_items"], b["change_summary"]) == (2, 0, "Initial recommendations generated")


def test_updated_explanations(spark):
    old = lists(spark, [(1, 5, 4.0, 0.5, 1)]).selectExpr("*", "'Because you liked X' AS explanation")
    existing = spark.createDataFrame([(1, 1, 3.0)], "user_id bigint, item_id bigint, rating double")
    new = spark.createDataFrame([(1, 2, 5.0)], "user_id bigint, item_id bigint, rating double")
    row = serving.incremental_update(old, existing, new).first()
    assert row["explanation"] == "Because you liked X (updated with new preferences)"
    assert (row["predicted"], row["confidence"]) == (4.25, 0.52)


def test_fallback_and_routing(spark):
    ratings = spark.createDataFrame(
        [(1, i, 4.0) for i in range(1, 16)] + [(2, 1, 4.0), (2, 2, 4.0)], "user_id bigint, item_id bigint, rating double"
    )
    popular = spark.createDataFrame([(100, 4.5, 200), (101, 4.4, 150)], "item_id bigint, avg_rating double, rating_count bigint")
    served = lists(spark, [(1, 50, 4.0, 0.5, 1), (2, 50, 4.0, 0.5, 1)])
    rows = serving.routed_lists(ratings, {"hybrid": served}, popular, "hybrid").collect()
    assert {(r["user_id"], r["item_id"], r["algorithm"]) for r in rows} == {
        (1, 50, "hybrid"), (2, 100, "fallback"), (2, 101, "fallback")
    }
    assert {r["confidence"] for r in rows if r["algorithm"] == "fallback"} == {0.6}
    only = serving.routed_lists(ratings, {}, popular, "content").collect()
    assert {r["algorithm"] for r in only} == {"fallback"} and len(only) == 4


def test_merged_ratings_override(spark):
    events = spark.createDataFrame(
        [(1, 1, 5, 3.0, "2024-01-01"), (2, 1, 5, 4.0, "2024-01-02"), (3, 1, 6, 2.0, "2024-01-01")],
        "event_id bigint, session_id bigint, item_id bigint, rating double, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {(r["item_id"], r["rating"]) for r in tables.latest_session_ratings(events).collect()}
    assert got == {(5, 4.0), (6, 2.0)}


def test_diversified_list(spark):
    # eight rows of one genre, then two of others: two per genre come first
    rows = [(1, i, 5 - i * 0.1, 0.5, i) for i in range(1, 11)]
    genres = {9: ["B"], 10: ["C"]}
    items = spark.createDataFrame([(i, genres.get(i, ["A"])) for i in range(1, 11)], "item_id bigint, genres array<string>")
    out = serving.diversify(lists(spark, rows), items).orderBy("rank").collect()
    assert [r["item_id"] for r in out] == [1, 2, 3, 9, 10, 4, 5, 6, 7, 8]
    short = serving.diversify(lists(spark, rows[:5]), items).orderBy("rank").collect()
    assert [r["item_id"] for r in short] == [1, 2, 3, 4, 5]


def test_search_rules(spark):
    items = tables.clean_items(spark.createDataFrame(
        [(1, "Lamp Garden (1995)", "Animation"), (2, "Frost (1995)", "Action")], "item_id bigint, title string, genres_text string"
    ))
    assert [r["item_id"] for r in catalog.search(items, query="lamp").collect()] == [1]
    assert [r["item_id"] for r in catalog.search(items, genre="animation").collect()] == [1]
    assert catalog.search(items, year=1995, limit=1).count() == 1
    with pytest.raises(ValueError):
        catalog.search(items)
    with pytest.raises(ValueError):
        catalog.search(items, query="x", limit=101)


def test_files(spark):
    path = scratch_path(spark, "ratings.dat")
    users = spark.createDataFrame([(1, "F", 25, 10, "48067")], schemas.USERS_FILE)
    files.write_delimited(users, path)
    assert files.read_delimited(spark, path, schemas.USERS_FILE).collect() == users.collect()
    with pytest.raises(FileNotFoundError):
        files.read_ratings_csv(spark, [path + "-absent"])
    assert files.missing_columns(users, schemas.RATINGS_FILE) == ["MovieID", "Rating", "Timestamp"]


def test_approximate_users_are_close(spark):
    ratings = spark.range(40_000).selectExpr("id AS user_id", "id % 4 AS item_id")
    for row in profile.approx_users(ratings).collect():
        assert abs(row["approx_users"] - 10_000) < 800
