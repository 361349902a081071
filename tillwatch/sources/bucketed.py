"""Entity tables in buckets by key, which joins read without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillwatch.sources.workspace import shared_folder


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str, path: str | None = None) -> str:
    """Save ``df`` as a table in sorted buckets, one file each, and return the table's name."""
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path or f"{shared_folder(df.sparkSession)}/{table}").saveAsTable(table)
    return table


def join_bucketed(fact: DataFrame, spark: SparkSession, table: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Left join with a bucketed table, bucket by bucket: facts are shuffled to its buckets, the table is not."""
    entity = spark.table(table)
    if columns is not None:
        entity = entity.select(key, *[c for c in columns if c != key])
    return fact.join(entity.hint("merge"), key, "left")
