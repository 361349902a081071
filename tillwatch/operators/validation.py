"""Row filters: required fields, usable keys, flagged rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch import schemas as S


def has_required(topic: str) -> Column:
    """True where every required field of the record type is present; blanks are accepted."""
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in S.REQUIRED_FIELDS[topic]])


def missing_fields(topic: str) -> Column:
    """Names of the required fields that a row lacks, in the order in which they are required."""
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name in S.REQUIRED_FIELDS[topic]]
    return F.array_compact(F.array(*names))


def tag_valid(df: DataFrame, topic: str) -> DataFrame:
    return df.withColumn("is_valid", has_required(topic))


def split_valid(df: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Both are plain filters, so cache ``df`` if it is costly."""
    return df.filter(has_required(topic)), df.filter(~has_required(topic))


def with_usable_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def flagged_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("predicted_fraud") == 1)
