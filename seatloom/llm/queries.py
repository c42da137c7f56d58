"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.llm import conversation_repair, decontaminate, exact_dedup, html_extract, language_id, license_scan, mixing, ranked_search, secret_scan, simhash, substring_dedup, topk_search, url_filter
from seatloom.runtime import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup(table(spark, sf_dir, "documents")))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.clusters(table(spark, sf_dir, "documents")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.train(docs.filter(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.digest(conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations"))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_simhash_near_dedup, op3_language_id, op4_topk_search, op5_decontaminate,
        op6_url_filter, op7_license_scan, op8_mix_sources, op9_secret_scan, op10_html_extract,
        op11_exact_dedup, op12_ranked_search, op13_conversation_repair,
    )
}

ORACLES = {
    "op4_topk_search": topk_search.ORACLE_SQL,
    "op6_url_filter": url_filter.ORACLE_SQL,
    "op8_mix_sources": mixing.ORACLE_SQL,
    "op11_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_ranked_search": ranked_search.ORACLE_SQL,
    "op13_conversation_repair": conversation_repair.ORACLE_SQL,
}
