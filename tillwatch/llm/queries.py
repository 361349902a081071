"""Registered queries of the pipeline operators, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.llm import cascade, decontaminate, exact, fm, jaccard, langid, licenses, lm, mixing, pii, repair, search, urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_pseudonymise(spark: SparkSession, directory: str) -> DataFrame:
    return pii.pseudonymise(table(spark, directory, "documents")).select("doc_id", "text", *pii.COLUMNS)


def op2_identify_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    filters = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict(rows, filters).drop("text")


def op3_decontaminate(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op4_mix_sources(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix(table(spark, directory, "documents"), carried=["doc_id"])


def op5_score_likelihood(spark: SparkSession, directory: str) -> DataFrame:
    return lm.scored(table(spark, directory, "documents"), carried=["doc_id"])


def op6_score_quality(spark: SparkSession, directory: str) -> DataFrame:
    docs, labels = table(spark, directory, "documents"), table(spark, directory, "labels")
    held_out = langid.held_out(F.col("doc_id"), 4, 2)
    machine = fm.learn(docs, labels.filter(~held_out))
    return fm.score(docs.select("doc_id", held_out.alias("held_out"), "text"), machine).drop("text")


def op7_judge_quality(spark: SparkSession, directory: str) -> DataFrame:
    return cascade.judge(table(spark, directory, "documents").select("doc_id", "text")).drop("text")


def op8_scan_licenses(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.scan(table(spark, directory, "documents").select("doc_id", "text")).drop("text")


def op9_filter_urls(spark: SparkSession, directory: str) -> DataFrame:
    return urls.judge(table(spark, directory, "pages")).select("page_id", *urls.COLUMNS)


def op10_join_ngrams(spark: SparkSession, directory: str) -> DataFrame:
    return jaccard.classes(table(spark, directory, "documents"))


def op11_rank_documents(spark: SparkSession, directory: str) -> DataFrame:
    return search.search(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


def op12_repair_conversations(spark: SparkSession, directory: str) -> DataFrame:
    conversations = table(spark, directory, "conversations")
    return repair.report(repair.damaged(conversations), conversations)


def op13_deduplicate(spark: SparkSession, directory: str) -> DataFrame:
    return exact.classes(table(spark, directory, "documents"))


QUERIES: dict[str, Query] = {
    "op1_pseudonymise": op1_pseudonymise,
    "op2_identify_language": op2_identify_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_mix_sources": op4_mix_sources,
    "op5_score_likelihood": op5_score_likelihood,
    "op6_score_quality": op6_score_quality,
    "op7_judge_quality": op7_judge_quality,
    "op8_scan_licenses": op8_scan_licenses,
    "op9_filter_urls": op9_filter_urls,
    "op10_join_ngrams": op10_join_ngrams,
    "op11_rank_documents": op11_rank_documents,
    "op12_repair_conversations": op12_repair_conversations,
    "op13_deduplicate": op13_deduplicate,
}

ORACLE_SQL: dict[str, str] = {
    "op4_mix_sources": mixing.SQL,
    "op7_judge_quality": cascade.SQL,
    "op11_rank_documents": search.SQL,
    "op13_deduplicate": exact.SQL,
}
