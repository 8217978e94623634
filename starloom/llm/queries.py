"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import conversation_repair, decontaminate, jaccard_join, language_id, lm_scoring, mixing, packing, quality_rules, secret_scan, substring_dedup, toxicity, url_filter, whitening
from starloom.llm.tables import crc_part, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def add(f):
        QUERIES[name] = f
        return f
    return add


@query("op2_secret_scan")
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(read(spark, folder, "documents", "doc_id", "text")))


@query("op5_language_id")
def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text", "lang")
    held_out = crc_part(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.identify(spark, rows, model).drop("text")


@query("op7_packing")
def packs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_decontamination")
def contaminated(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark", "item_id", "text"))
    return decontaminate.digest(found)


@query("op1_quality_rules")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(read(spark, folder, "documents", "doc_id", "text")).drop("clean_text")


ORACLES["op1_quality_rules"] = quality_rules.oracle()


@query("op3_url_filter")
def urls(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages", "page_id", "url"))


ORACLES["op3_url_filter"] = url_filter.oracle()


@query("op10_toxicity")
def toxic(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    held_out = crc_part(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs.where(~held_out), read(spark, folder, "labels", "doc_id", "toxic"))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("features")


@query("op9_jaccard_join")
def similar(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_groups(read(spark, folder, "documents", "doc_id", "text"))


@query("op4_substring_dedup")
def substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.without_repeats(read(spark, folder, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_lm_scoring")
def likelihood(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return lm_scoring.scored(docs, "coalesce(crc32(cast(doc_id AS string)) % 5, 0) <> 1")


@query("op11_source_mix")
def mixed(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(mixing.mix(read(spark, folder, "documents", "doc_id", "text", "source")))


ORACLES["op11_source_mix"] = mixing.oracle()


@query("op12_whitening")
def whitened(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings", "vec_id", "embedding")
    return whitening.whiten(vectors, whitening.train(vectors))


@query("op13_conversation_repair")
def repaired(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_repair.damaged(read(spark, folder, "conversations", "conv_id", "turn", "role", "text"))
    return conversation_repair.digest(conversation_repair.repair(turns))
