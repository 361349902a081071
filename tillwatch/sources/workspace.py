"""Folders for intermediate tables, where driver and executors both see them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; on one machine a temporary one, if none is named."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"name a folder that all machines see in {SETTING}")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read back, which cuts its lineage and freezes what it holds."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a job go when it ends, not when the driver collects garbage; run no plan twice there."""
    with _set(spark, CLEANUP, "true"):
        yield


@contextmanager
def tasks_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Within it, Spark joins shuffle partitions up to ``size`` bytes, or to what is set already if that is less."""
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with _set(spark, TASK_BYTES, str(min(size, as_bytes(spark.conf.get(TASK_BYTES))))):
        yield
