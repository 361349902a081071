"""Rule-based cleaning of the four record types.

The rules of a record type are one dictionary, applied in a single projection.
Derived columns come second, since they read columns that are already clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch import schemas as S
from tillwatch.functions import features as X
from tillwatch.functions.cleaners import (
    Rule, bounded, inside_or, magnitude, one_if, trimmed_or, upper_or, value_or,
)

USER_RULES: dict[str, Rule] = {
    "region_code": upper_or("UNK"),
    "address_line": trimmed_or(""),
    "income_level": upper_or("MEDIUM"),
    "age": bounded(0, 110),
    "age_group": upper_or("UNKNOWN"),
    "home_latitude": value_or(0.0),
    "home_longitude": value_or(0.0),
}

MERCHANT_RULES: dict[str, Rule] = {
    "mcc_group": upper_or("UNK"),
    "merchant_display_name": trimmed_or("Merchant"),
    "geo_lat": bounded(-90.0, 90.0, 0.0),
    "geo_lon": bounded(-180.0, 180.0, 0.0),
    "risk_score_merchant": bounded(0.0, 1.0, 0.0),
    "merchant_type": upper_or("UNKNOWN"),
    "is_high_risk": one_if(1),
    "avg_txn_amount_minor": value_or(0),
}

CARD_RULES: dict[str, Rule] = {
    "product_type": upper_or("UNKNOWN"),
    "brand": upper_or("UNKNOWN"),
    "days_since_issuance": bounded(low=0),
    "card_age_category": upper_or("UNKNOWN"),
    "is_primary_card": one_if(1),
    "daily_limit_minor": bounded(0, S.DAILY_LIMIT_CAP_MINOR),
}

TXN_RULES: dict[str, Rule] = {
    "amount_minor": bounded(low=0),
    "amount_sign": one_if(-1, otherwise=1),
    "currency": upper_or("VND"),
    "channel_code": upper_or("POS"),
    "entry_mode": upper_or("CHIP"),
    "risk_score_online": bounded(0.0, 1.0, 0.0),
    "hour_of_day": inside_or(0, 23, 0),
    "distance_from_home_km": magnitude(),
    "exceeds_daily_limit": one_if(1),
    "amount_deviation_ratio": magnitude(),
    "days_since_card_issued": bounded(low=0),
}


def apply_rules(df: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    return df.withColumns({name: rule(F.col(name)) for name, rule in rules.items() if name in df.columns})


def clean_users(df: DataFrame) -> DataFrame:
    return apply_rules(df, USER_RULES)


def clean_merchants(df: DataFrame) -> DataFrame:
    return apply_rules(df, MERCHANT_RULES)


def clean_cards(df: DataFrame) -> DataFrame:
    return apply_rules(df, CARD_RULES)


def clean_transactions(df: DataFrame, hour_from_event_time: bool = False) -> DataFrame:
    """Clean transactions and recompute the derived columns.

    A bad hour becomes 0 and therefore counts as unusual. With
    ``hour_from_event_time`` the hour is taken from the event time instead.
    """
    out = apply_rules(df, TXN_RULES).withColumns({
        "amount_major": F.coalesce(F.col("amount_major"), X.major_units(F.col("amount_minor"))),
        "trans_date_trans_time": X.event_time(F.col("event_epoch_sec")),
    })
    if hour_from_event_time:
        hour: Column = F.coalesce(F.hour("trans_date_trans_time"), F.lit(0))
        out = out.withColumn("hour_of_day", hour)
    return out.withColumns({
        "is_unusual_hour": X.unusual_hour(F.col("hour_of_day")),
        "amount_category": X.amount_category(F.col("amount_major")),
    })


CLEANERS = {
    S.USER_TOPIC: clean_users,
    S.MERCHANT_TOPIC: clean_merchants,
    S.CARD_TOPIC: clean_cards,
    S.TXN_TOPIC: clean_transactions,
}
