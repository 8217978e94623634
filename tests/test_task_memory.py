"""What a task holds does not grow with the tables."""

import datetime

from pyspark.sql import functions as F

from starloom.operators import catalog, profile
from starloom.plans import registry
from starloom.sources import tables


def test_many_lines_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    day = datetime.datetime(2020, 1, 1)
    lines = spark.range(600).selectExpr("id % 90 AS l_orderkey", "id % 7 AS l_partkey", "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(90).select(F.col("id").alias("o_orderkey"), (F.col("id") % 11).alias("o_custkey"), F.lit(day).alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    before = sorted(tables.ratings(spark, str(tmp_path)).collect())
    monkeypatch.setattr(tables, "TASK_LINES", 20)
    ratings = tables.ratings(spark, str(tmp_path))
    assert ratings.rdd.getNumPartitions() == 30 and sorted(ratings.collect()) == before
    # the pairs counted for distinct users lie where they were grouped
    plan = profile.item_stats(ratings)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1


def test_metadata_groups_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    lines = spark.range(600).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 7 AS l_partkey", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "concat('n', id % 3) AS p_name", "'t' AS p_type", "CAST(id AS INT) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    query = registry.QUERIES["d10_best_metadata"]
    before = sorted(query(spark, str(tmp_path)).collect())
    monkeypatch.setattr(tables, "TASK_LINES", 20)
    out = query(spark, str(tmp_path))
    assert sorted(out.collect()) == before and len(before) == 7
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()


def test_an_item_meets_its_titles_years_in_one_row(spark):
    items = spark.createDataFrame([(1, "A", 1990), (2, "A", None), (3, "B", 2000), (3, "B", 1999), (4, "C", 1)], "item_id bigint, clean_title string, year int")
    meta = spark.createDataFrame(
        [("A", y, 5, y) for y in range(1980, 2000)] + [("B", 1998, 1, 7), ("B", None, 0, 8), ("A", 1990, 4, 70)],
        "search_title string, release_year int, position int, meta_id int")
    out = catalog.best_metadata(items, meta)
    got = {r["item_id"]: (r["tier"], r["meta_id"]) for r in out.collect()}
    assert got == {1: (0, 70), 2: (2, 70), 3: (1, 7)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" in plan


def test_medians_are_not_kept_per_item_and_user(spark):
    rows = [(1, 1, 2.0), (2, 1, 4.0), (2, 1, 5.0), (None, 1, 1.0), (None, 2, 3.0), (3, None, 1.0), (4, None, 2.0)]
    stats = profile.feature_stats(spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"))
    got = {r["item_id"]: (r["num_ratings"], r["median_rating"], r["num_users"]) for r in stats.collect()}
    assert got == {1: (4, 3.0, 2), 2: (1, 3.0, 0), None: (2, 1.5, 2)}
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "user_id" in line and ("median" in line or "percentile" in line) and "Aggregate" in line]
