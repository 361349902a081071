"""Model artifacts kept as opaque files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_artifacts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, modificationTime, length, content)`` of the matching files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def read_artifact(spark: SparkSession, path: str) -> bytes:
    """Content of one artifact file, for the driver to unpack and broadcast."""
    rows = spark.read.format("binaryFile").load(path).select("content").take(2)
    if len(rows) != 1:
        raise ValueError(f"expected one file at {path}, found {'none' if not rows else 'several'}")
    return bytes(rows[0]["content"])


def artifact_listing(spark: SparkSession, path: str) -> DataFrame:
    """Names and sizes only; the contents are not read."""
    return read_artifacts(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")
