"""Feature columns and the frame a model reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillwatch import schemas as S
from tillwatch.functions import features as X
from tillwatch.functions.cleaners import numeric_or_null, rounded
from tillwatch.sources.static import local_table


def with_time_features(df: DataFrame, ts: str = "trans_date_trans_time") -> DataFrame:
    """``hour``, ``day_of_week`` (Monday is 0) and ``month``."""
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": X.monday_based_weekday(F.col(ts)),
        "month": F.month(ts),
    })


def with_age_at(df: DataFrame, ts: str = "trans_date_trans_time", birth_date: str = "dob") -> DataFrame:
    """Replace the profile age by the age at the transaction, where there is a birth-date column."""
    if birth_date not in df.columns:
        return df
    return df.withColumn("age", X.age_at(F.col(ts), F.col(birth_date)))


def with_distance(df: DataFrame) -> DataFrame:
    """Home to merchant, over the columns left by the lookups."""
    distance = X.haversine_km(F.col("home_latitude"), F.col("home_longitude"), F.col("merch_lat"), F.col("merch_long"))
    return df.withColumn("distance_from_home_km", rounded(distance, 2))


def with_limit_features(df: DataFrame, base: str = "daily_limit_minor") -> DataFrame:
    """Limit flag and amount deviation. The deviation base is the card limit unless told otherwise."""
    return df.withColumns({
        "exceeds_daily_limit": X.exceeds_limit(F.col("amount_minor"), F.col("daily_limit_minor")),
        "amount_deviation_ratio": X.deviation_ratio(F.col("amount_minor"), F.col(base)),
    })


def with_card_age(df: DataFrame) -> DataFrame:
    """Carry the card's age onto the transaction."""
    return df.withColumn("days_since_card_issued", F.coalesce("days_since_issuance", F.lit(0)))


def with_derived_risk(df: DataFrame) -> DataFrame:
    """All features that need more than the transaction itself, and the rule score over them."""
    out = with_card_age(with_limit_features(with_distance(df)))
    score = X.rule_score(
        F.col("is_unusual_hour"), F.col("exceeds_daily_limit"), F.col("distance_from_home_km"), F.col("amount_category")
    )
    return out.withColumn("txn_fraud_probability", score)


def with_merchant_risk(df: DataFrame, category: str = "mcc_group") -> DataFrame:
    """Base risk of the merchant category and the flag derived from it."""
    schema = StructType([StructField(category, StringType()), StructField("_risk", DoubleType())])
    risks = local_table(df.sparkSession, list(S.MERCHANT_BASE_RISK.items()), schema)
    risk = F.least(F.greatest(F.coalesce("_risk", F.lit(S.MERCHANT_DEFAULT_RISK)), F.lit(0.0)), F.lit(1.0))
    return df.join(F.broadcast(risks), category, "left").withColumn("merchant_risk", rounded(risk, 3)).drop("_risk").withColumn(
        "is_high_risk", X.high_risk_flag(F.col("merchant_risk"))
    )


def drop_non_features(df: DataFrame) -> DataFrame:
    return df.drop(*S.NON_FEATURE_COLUMNS)


def align(df: DataFrame, feature_names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The named columns in order: missing ones become null, extra ones go, ``keep`` stays in front."""
    present = set(df.columns)
    features = [
        F.col(name) if name in present else F.lit(None).cast("double").alias(name) for name in feature_names
    ]
    return df.select(*keep, *features)


def feature_frame(
    enriched: DataFrame, feature_names: Sequence[str], keep: Sequence[str] = (), coerce_numeric: bool = False
) -> DataFrame:
    """Enriched transactions to model input.

    ``coerce_numeric`` turns every feature into a number and text into null;
    without it text features keep their values for an encoder.
    """
    out = enriched.withColumn("amt", F.coalesce("amount_major", F.lit(0.0)))
    out = align(drop_non_features(with_age_at(with_time_features(out))), feature_names, keep)
    if coerce_numeric:
        out = out.withColumns({name: numeric_or_null(F.col(name)) for name in feature_names})
    return out
