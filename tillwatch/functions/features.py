"""Feature expressions over transaction, card, user and merchant columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwatch import schemas as S
from tillwatch.functions.cleaners import banded, rounded


# ------------------------------------------------------------------------ time
def event_time(epoch_seconds: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def monday_based_weekday(ts: Column) -> Column:
    return F.weekday(ts)


def hour_of_iso(text: Column) -> Column:
    """Wall-clock hour written in an ISO-8601 string; 0 where it does not parse.

    The hour is the one of the written offset, so the offset is dropped before parsing.
    """
    local = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.coalesce(F.hour(local.try_cast("timestamp_ntz")), F.lit(0))


def unusual_hour(hour: Column) -> Column:
    return F.when(hour.isin(S.UNUSUAL_HOURS), F.lit(1)).otherwise(F.lit(0))


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


# ------------------------------------------------------------------------- age
def age_at(ts: Column, birth_date: Column) -> Column:
    """Whole 365-day years between birth and transaction; null for a bad birth date."""
    days = F.datediff(ts.cast("date"), birth_date.try_cast("date"))
    return F.floor(days / 365).cast("int")


def age_from_years(as_of_year: Column, birth_year: Column) -> Column:
    """Year difference kept in 0..100; null birth year stays null."""
    years = as_of_year - birth_year
    return F.when(years < 0, F.lit(0)).when(years > 100, F.lit(100)).otherwise(years)


def age_group(age: Column) -> Column:
    return banded(age, S.AGE_BANDS)


def card_age_category(days: Column) -> Column:
    return banded(days, S.CARD_AGE_BANDS)


# ------------------------------------------------------------------- geography
def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; 0.0 if any coordinate is missing."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    )
    distance = F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * S.EARTH_RADIUS_KM)
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, distance).otherwise(F.lit(0.0))


# ---------------------------------------------------------------------- amounts
def major_units(minor: Column) -> Column:
    """Minor units are whole, so the quotient already carries two decimals."""
    return minor / F.lit(100.0)


def amount_category(major: Column) -> Column:
    return banded(major, S.AMOUNT_BANDS)


def exceeds_limit(amount_minor: Column, limit_minor: Column) -> Column:
    limit = F.coalesce(limit_minor, F.lit(S.DEFAULT_DAILY_LIMIT_MINOR))
    return F.when(amount_minor > limit, F.lit(1)).otherwise(F.lit(0))


def deviation_ratio(amount_minor: Column, base_minor: Column) -> Column:
    """Distance from a base amount, relative to it. The base is the caller's choice."""
    base = F.coalesce(base_minor, F.lit(S.DEFAULT_DEVIATION_BASE_MINOR)).cast("bigint")
    return rounded(F.abs(amount_minor - base) / F.greatest(base, F.lit(1)), 3)


# -------------------------------------------------------------------------- risk
def rule_score(is_unusual: Column, is_over_limit: Column, distance_km: Column, category: Column) -> Column:
    """Transparent additive fraud probability.

    Summed in whole thousandths, so that the result does not depend on the order of the terms.
    """

    def thousandths(weight: float) -> int:
        return round(weight * 1000)

    def points(condition: Column, weight: float) -> Column:
        return F.when(condition, F.lit(thousandths(weight))).otherwise(F.lit(0))

    total = (
        F.lit(thousandths(S.RULE_BASE))
        + points(is_unusual == 1, S.RULE_UNUSUAL_HOUR)
        + points(is_over_limit == 1, S.RULE_OVER_LIMIT)
        + points(distance_km > S.FAR_FROM_HOME_KM, S.RULE_FAR)
        + points(category.isin(S.LARGE_CATEGORIES), S.RULE_LARGE_AMOUNT)
    )
    return F.least(total, F.lit(thousandths(S.RULE_MAX))) / F.lit(1000.0)


def high_risk_flag(risk: Column) -> Column:
    return F.when(risk > S.HIGH_RISK_ABOVE, F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------------- identity
def pan_token(pan: Column) -> Column:
    """One-way token of a card number, stable across processes and runs."""
    return F.concat(F.lit("h_"), F.sha2(pan, 256))


def pan_last4(pan: Column) -> Column:
    return F.right(pan, F.lit(4))


def full_name(family: Column, given: Column) -> Column:
    return F.concat_ws(" ", family, given)
