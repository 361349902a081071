"""The registered queries: each takes ``(spark, directory)`` and reads the batch tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwatch.plans.dataset import Dataset
from tillwatch.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Dataset], DataFrame]) -> Callable[[Dataset], DataFrame]:
    """Register a query over a dataset under its function name, in a UTC session."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        return fn(Dataset(apply_runtime_conf(spark), directory))

    QUERIES[fn.__name__] = run
    return fn
