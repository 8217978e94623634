"""A training-data pipeline of five stages over the documents table.

Each stage gets all rows that the one before kept, as a Parquet table, and its
decisions take effect: documents in no learned language go, one document of
each group of near copies stays, documents that hold passages of benchmark
items go, secrets are masked, and what is left is packed into sequences. All but the
last return the columns of documents.

Extra columns are carried along. Every stage gives an empty result for an empty
table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import decontaminate, jaccard_join, language_id, packing, secret_scan
from starloom.llm.tables import ARROW_ROWS, Scratch, crc_part, matching, read, stored

#: Least probability of the language; texts without letters have none.
LEAST_PROBABILITY = 0.5
#: Near copies share this part of their shingles of so many words (``op9`` has its own figures).
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: Documents that go to Python at once.
BATCH_ROWS = 1000

ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """Sends fewer rows to Python at once than Spark's default of 10,000, as the rows of this application hold whole texts."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with marks added until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language the model does not tell: null and letterless texts, and unsure ones."""
    small_batches(spark)
    model = language_id.train(docs.where(crc_part(F.col("doc_id"), 3) != 1))
    lang, score = free_name(docs, "found_lang"), free_name(docs, "found_score")
    known = language_id.identify(spark, docs, model, lang_name=lang, score_name=score)
    return known.where((F.col(lang) != "und") & (F.col(score) >= LEAST_PROBABILITY)).drop(lang, score)


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked documents.

    Rows that share an id are one document and stay together. Documents without
    words are in no group and stay, and so do rows without an id.
    """
    small_batches(spark)
    groups = jaccard_join.similar_groups(docs, k=NEAR_WORDS, percent=NEAR_PERCENT)
    copies = stored(groups.where("doc_id IS NOT NULL AND doc_id <> component_id").select("doc_id").distinct(), "copies")
    return matching(docs, copies, copies.count(), "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item, with or without an id."""
    small_batches(spark)
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the text; ``n_chars`` follows the new text."""
    small_batches(spark)
    masked = secret_scan.mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("jaccard_join", keep_one_of_a_group),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
        if last is not None:
            scratch.drop(last)
        last = docs
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
