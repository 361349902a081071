"""Scoring flows: clean transactions plus served entities in, scored transactions out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwatch import schemas as S
from tillwatch.functions.cleaners import numeric_or_null
from tillwatch.operators.enrich import enrich
from tillwatch.operators.features import with_age_at, with_derived_risk, with_time_features
from tillwatch.operators.latest import instant, latest_by_key
from tillwatch.operators.ml import Ensemble
from tillwatch.operators.scoring import logistic, mean_probability, opaque_ensemble, with_decision

# The rule score stays below 0.215, so its cut-off is its own parameter.
RULE_THRESHOLD = 0.1

# Event time first, then arrival; the unique event id settles ties.
VERSION_ORDER = ("event_ts", "batch_id", "kafka_offset", "event_id")

# What the rule score reads of each entity.
RULE_COLUMNS = {
    "cards": ["party_id", "daily_limit_minor", "days_since_issuance"],
    "users": ["home_latitude", "home_longitude"],
    "merchants": ["category", "merch_lat", "merch_long"],
}
# What the formula scorer reads on top of that.
FORMULA_COLUMNS = {
    "cards": RULE_COLUMNS["cards"],
    "users": [*RULE_COLUMNS["users"], "dob"],
    "merchants": [*RULE_COLUMNS["merchants"], "risk_score_merchant", "is_high_risk"],
}

Scorer = Callable[[DataFrame], DataFrame]


def score_by_rules(enriched: DataFrame, threshold: float = RULE_THRESHOLD) -> DataFrame:
    return with_decision(with_derived_risk(enriched), F.col("txn_fraud_probability"), threshold)


def formula_members() -> list[Column]:
    """Three fixed logistic formulas over the feature columns."""
    return [
        logistic({"amt": 0.004, "is_unusual_hour": 0.8, "exceeds_daily_limit": 0.9}, -2.1),
        logistic({"distance_from_home_km": 0.0004, "risk_score_merchant": 1.7, "is_high_risk": 0.6}, -1.9),
        logistic({"risk_score_online": 2.3, "age": -0.011, "hour": 0.013, "day_of_week": 0.07, "month": -0.03}, -0.6),
    ]


def with_model_features(enriched: DataFrame) -> DataFrame:
    """The columns models read, added to the enriched transaction."""
    featured = with_age_at(with_time_features(enriched))
    return featured.withColumn("amt", F.coalesce("amount_major", F.lit(0.0)))


def score_by_formulas(enriched: DataFrame, threshold: float = S.FRAUD_THRESHOLD) -> DataFrame:
    featured = with_derived_risk(with_model_features(enriched))
    return with_decision(featured, mean_probability(formula_members()), threshold)


def score_by_ensemble(enriched: DataFrame, ensemble: Ensemble, threshold: float = S.FRAUD_THRESHOLD) -> DataFrame:
    """Score with a fitted or loaded Spark ML ensemble."""
    scored = ensemble.score(with_model_features(enriched))
    return with_decision(scored, F.col("fraud_probability"), threshold)


def opaque_scorer(
    spark: SparkSession,
    models: Sequence[Any],
    feature_names: Sequence[str],
    preprocess: Callable[[pd.DataFrame], Any] | None = None,
    threshold: float = S.FRAUD_THRESHOLD,
    coerce_numeric: bool = False,
) -> Scorer:
    """A scorer that runs the caller's own models on the features of a saved list of names.

    Names that no column has are null to the models. ``preprocess`` turns the
    frame of a batch into what they take.
    """
    probability = opaque_ensemble(spark, models, feature_names, preprocess)

    def score(enriched: DataFrame) -> DataFrame:
        featured = with_model_features(enriched)
        columns = [F.col(n) if n in featured.columns else F.lit(None).cast("double") for n in feature_names]
        if coerce_numeric:
            columns = [numeric_or_null(c) for c in columns]
        return with_decision(featured, probability(*[c.alias(n) for c, n in zip(columns, feature_names)]), threshold)

    score.release = probability.release
    return score


def score_transactions(
    txns: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    scorer: Scorer = score_by_rules,
    **lookup_options,
) -> DataFrame:
    """Lookups, features and score as one plan. Entities need one row per key."""
    return scorer(enrich(txns, cards, users, merchants, **lookup_options))


def latest_entities(served: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Latest served row per key, ordered by whatever version columns the rows have.

    ``columns`` are the ones the flow reads; nothing else is then shuffled.
    """
    order = [name for name in VERSION_ORDER if name in served.columns]
    if columns is not None:
        served = served.select(key, *[name for name in columns if name != key], *order)
    by = [instant(name) if name == "event_ts" else F.col(name) for name in order]
    return latest_by_key(served, key, by)
