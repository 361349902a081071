"""A training corpus from raw documents.

Language identification, near-duplicate removal, benchmark decontamination,
pseudonyms for personal data, and a mix of the sources at target weights. Each
stage takes the documents that the one before it kept, and all but the last
return the columns of ``documents``. The last one returns a row for each copy in
the mix, with the columns of the mix beside those of the document.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns
are handled as the operators' modules say. Texts that are null or have no letter
end at the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.llm import decontaminate, jaccard, langid, mixing, pii
from tillwatch.llm.shared import set_aside, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.identified(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.deduplicated(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in the place of personal data; ``n_chars`` follows the text."""
    plain, back = set_aside(docs, *pii.COLUMNS)
    replaced = pii.pseudonymise(plain).drop(*pii.COLUMNS).withColumnsRenamed(back)
    if "n_chars" in docs.columns:
        length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        replaced = replaced.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return staged(replaced.select(*docs.columns), "pseudonyms")  # its plan is long; nothing after it repeats it


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row for each copy."""
    return mixing.repeated(mixing.mix(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("benchmark", remove_benchmark),
    ("personal_data", pseudonymise),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The learned filters and the keyed permutations have no SQL; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None
