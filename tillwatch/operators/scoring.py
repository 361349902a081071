"""Ensemble scoring and the decision made from it."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

import tillwatch
from tillwatch import schemas as S


MOST_MODEL_BYTES = 1 << 30


def logistic(weights: Mapping[str, float], bias: float) -> Column:
    """A logistic model as a column expression; missing features count as 0."""
    margin = F.lit(float(bias))
    for name, weight in weights.items():
        margin = margin + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * float(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def mean_probability(members: Sequence[Column]) -> Column:
    total = members[0]
    for member in members[1:]:
        total = total + member
    return total / F.lit(float(len(members)))


def with_decision(df: DataFrame, probability: Column, threshold: float = S.FRAUD_THRESHOLD) -> DataFrame:
    """Add ``fraud_probability`` and ``predicted_fraud``.

    Only transactions with a known card are scored; the others keep a null
    probability and a prediction of 0.
    """
    gated = F.when(F.col("card_found"), probability) if "card_found" in df.columns else probability
    return df.withColumn("fraud_probability", gated).withColumn(
        "predicted_fraud", F.when(F.col("fraud_probability") >= threshold, F.lit(1)).otherwise(F.lit(0))
    )


def opaque_ensemble(
    spark: SparkSession,
    models: Sequence[Any],
    feature_names: Sequence[str],
    preprocess: Callable[[pd.DataFrame], Any] | None = None,
) -> Callable[..., Column]:
    """Mean ``predict_proba`` of models Spark knows nothing about, batch by batch over Arrow.

    The models are shipped once per executor as a broadcast variable and unpacked
    once per task; ``MOST_MODEL_BYTES`` bounds their size. The result is a function
    of columns, ``opaque_ensemble(...)(*feature_columns)``, whose ``release()`` frees
    the variable once nothing scores with it any more.
    """
    names = list(feature_names)
    packed = _packed((list(models), preprocess))
    if len(packed) > MOST_MODEL_BYTES:
        raise ValueError(f"models of {len(packed)} bytes are too large to broadcast")
    shared = spark.sparkContext.broadcast(packed)

    @F.pandas_udf(DoubleType())
    def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        members, prepare = pickle.loads(shared.value)
        for frame in batches:
            frame = frame.set_axis(names, axis="columns")
            inputs = frame if prepare is None else prepare(frame)
            yield pd.Series(sum(member.predict_proba(inputs)[:, 1] for member in members) / len(members))

    def scored(*columns: Column) -> Column:
        return probability(F.struct(*columns))

    scored.release = shared.destroy
    return scored


def _packed(value: Any) -> bytes:
    """Pickled so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(tillwatch)
    try:
        return cloudpickle.dumps(value)
    finally:
        cloudpickle.unregister_pickle_by_value(tillwatch)
