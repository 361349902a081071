"""Data-quality profile: how many raw rows each dirty-value rule hits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch import schemas as S


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def _outside(name: str, low, high) -> Column:
    return F.col(name).isNull() | ~F.col(name).between(low, high)


def _below_zero(name: str) -> Column:
    return F.col(name) < 0


def quality_rules(topic: str) -> dict[str, Column]:
    """Rule name to predicate on raw rows of the record type."""
    if topic == S.USER_TOPIC:
        return {
            "blank_income_level": _blank("income_level"),
            "blank_region_code": _blank("region_code"),
            "unknown_region_code": F.trim(F.col("region_code")) == "??",
            "padded_address": F.col("address_line") != F.trim(F.col("address_line")),
            "missing_home_latitude": F.col("home_latitude").isNull(),
            "birth_year_mismatch": F.year(F.col("birth_date").try_cast("date")) != F.col("birth_year"),
            "age_out_of_range": _outside("age", 0, 110),
        }
    if topic == S.CARD_TOPIC:
        return {
            "blank_product_type": _blank("product_type"),
            "blank_brand": _blank("brand"),
            "unknown_brand": F.trim(F.col("brand")) == "???",
            "negative_days_since_issuance": _below_zero("days_since_issuance"),
            "negative_daily_limit": _below_zero("daily_limit_minor"),
            "over_cap_daily_limit": F.col("daily_limit_minor") > S.DAILY_LIMIT_CAP_MINOR,
        }
    if topic == S.MERCHANT_TOPIC:
        return {
            "blank_mcc_group": _blank("mcc_group"),
            "latitude_out_of_range": _outside("geo_lat", -90, 90),
            "longitude_out_of_range": _outside("geo_lon", -180, 180),
            "lower_case_name": F.col("merchant_display_name") == F.lower(F.col("merchant_display_name")),
            "risk_out_of_range": _outside("risk_score_merchant", 0, 1),
        }
    return {
        "blank_channel_code": _blank("channel_code"),
        "blank_currency": _blank("currency"),
        "bad_hour": _outside("hour_of_day", 0, 23),
        "negative_amount": _below_zero("amount_minor"),
        "missing_amount_major": F.col("amount_major").isNull(),
        "negative_amount_major": _below_zero("amount_major"),
        "risk_out_of_range": _outside("risk_score_online", 0, 1),
    }


def quality_profile(df: DataFrame, topic: str) -> DataFrame:
    """``(topic, rule, hits, total)`` from a single pass over ``df``."""
    rules = quality_rules(topic)
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(p).alias(name) for name, p in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("hits")) for n in rules])
    return counts.select("total", F.inline(pairs)).select(F.lit(topic).alias("topic"), "rule", "hits", "total")


def quality_report(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality_profile(df, topic) for topic, df in frames.items()])
