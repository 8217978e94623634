"""Reading and writing the raw files, catalogue exports and model tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from starloom import schemas

DELIMITER = "::"
LATIN = "ISO-8859-1"


def read_delimited(spark: SparkSession, path: str, schema: StructType, encoding: str = LATIN) -> DataFrame:
    """A ``::``-separated file without header; quotes are ordinary characters."""
    return spark.read.schema(schema).csv(path, sep=DELIMITER, quote="", encoding=encoding)


def write_delimited(df: DataFrame, path: str) -> None:
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(DELIMITER, *fields)).write.text(path)


def first_existing(paths: list[str], read) -> DataFrame:
    """The first of several locations that can be read."""
    for path in paths:
        try:
            return read(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {paths} exists")


def read_ratings_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Ratings with a header line, from the first location that exists."""
    read = spark.read.schema(schemas.RATINGS_FILE)
    return first_existing(paths, lambda p: read.csv(p, header=True))


def read_records(spark: SparkSession, paths: list[str], schema: StructType, one_array: bool = True) -> DataFrame:
    """Records of a JSON file: one array, or one object per line.

    An array cannot be split between tasks; large exports use lines.
    """
    read = spark.read.schema(schema)
    return first_existing(paths, lambda p: read.json(p, multiLine=one_array))


def _catalogue(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("item_id").alias("MovieID"),
        F.col("title").alias("Title"),
        F.col("genres_text").alias("Genres"),
        F.col("year").alias("Year"),
        F.col("clean_title").alias("CleanTitle"),
        F.col("genres").alias("GenreList"),
        F.col("web_title").alias("WebTitle"),
    )


def export_catalogue(items: DataFrame, path: str) -> None:
    """Cleaned items as JSON lines under the exported names."""
    _catalogue(items).write.json(path)


def export_arrays(items: DataFrame, path: str, per_file: int = 5000) -> None:
    """Cleaned items as files that hold one JSON array of about ``per_file`` records each."""
    n = max(1, -(-items.count() // per_file))
    records = _catalogue(items)
    record = F.struct(*records.columns)
    arrays = records.groupBy(F.pmod(F.xxhash64("MovieID"), F.lit(n)).alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("part").text(path)


def export_ratings(ratings: DataFrame, path: str) -> None:
    ratings.select(
        F.col("user_id").alias("UserID"),
        F.col("item_id").alias("MovieID"),
        F.col("rating").alias("Rating"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("Timestamp"),
    ).write.csv(path, header=True)


def export_summary(summary: DataFrame, path: str) -> None:
    """The one-row quality summary as JSON."""
    summary.write.json(path)


def save_model(folder: str, tables: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None) -> None:
    """Model tables as Parquet, one folder per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{folder}/{name}")


def load_model(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def missing_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Columns of ``schema`` that ``df`` lacks or holds in another type."""
    have = {f.name: f.dataType for f in df.schema}
    return [f.name for f in schema if have.get(f.name) != f.dataType]


def presence(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """``(path, present, problem)`` for required Parquet tables."""
    rows = []
    for path in paths:
        try:
            missing = missing_columns(first_existing([path], spark.read.parquet), schema)
            rows.append((path, True, ", ".join(missing)))
        except FileNotFoundError:
            rows.append((path, False, "not found"))
    return spark.createDataFrame(rows, "path string, present boolean, problem string")


def structure(df: DataFrame) -> DataFrame:
    """Column names, types, null counts and row count of a table, in one pass."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls"),
        )
        for i, f in enumerate(df.schema)
    ]
    row = df.agg(F.array(*cells).alias("cells"), F.count("*").alias("rows"))
    return row.select(F.inline("cells"), "rows")
