"""Entity rows as they are served: renamed columns, city columns, usable keys only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.operators.joins import lookup
from tillwatch.operators.validation import with_usable_key
from tillwatch.sources.static import city_table

# Event column to served column.
USER_COLUMNS = {
    "given_name": "first",
    "family_name": "last",
    "gender_code": "gender",
    "address_line": "street",
    "region_code": "state",
    "home_postal_hint": "zip",
    "occupation_title": "job",
    "birth_date": "dob",
}
USER_CARRIED = ["age", "age_group", "income_level", "home_latitude", "home_longitude"]

CITY_COLUMNS = ["city", "lat", "long", "city_pop"]

MERCHANT_COLUMNS = {
    "merchant_display_name": "merchant",
    "mcc_group": "category",
    "geo_lat": "merch_lat",
    "geo_lon": "merch_long",
}
MERCHANT_CARRIED = ["risk_score_merchant", "avg_txn_amount_minor", "merchant_type", "is_high_risk"]

CARD_COLUMNS = {"party_id_fk": "party_id", "card_pan_last4": "cc_last4"}
CARD_CARRIED = [
    "product_type", "brand", "days_since_issuance", "card_age_category", "is_primary_card", "daily_limit_minor",
]

# Columns that order the versions of an entity; present when the source has them.
ORDER_COLUMNS = ["event_ts", "batch_id", "kafka_partition", "kafka_offset", "event_id"]


def _renamed(mapping: dict[str, str], carried: list[str]) -> list[Column]:
    return [F.col(old).alias(new) for old, new in mapping.items()] + [F.col(name) for name in carried]


def _ordering(df: DataFrame) -> list[str]:
    return [name for name in ORDER_COLUMNS if name in df.columns]


def with_city(users: DataFrame, cities: DataFrame | None = None, home_from_city: bool = False) -> DataFrame:
    """Add ``city, lat, long, city_pop``; an unknown location gets ``Unknown`` and zeros.

    With ``home_from_city`` a home at (0, 0), which is what cleaning leaves for
    missing coordinates, takes the coordinates of the city.
    """
    source = cities if cities is not None else city_table(users.sparkSession)
    table = source.select(
        F.col("location_id").alias("location_id_home"), "city", F.col("lat"), F.col("long"),
        F.col("population").alias("city_pop"),
    )
    # The fixed table has three rows; of a caller's own the size is not known, and few places have many users.
    placed = users.join(F.broadcast(table), "location_id_home", "left") if cities is None else lookup(
        users, table, "location_id_home")
    out = placed.withColumns({
        "city": F.coalesce("city", F.lit("Unknown")),
        "lat": F.coalesce("lat", F.lit(0.0)),
        "long": F.coalesce("long", F.lit(0.0)),
        "city_pop": F.coalesce("city_pop", F.lit(0)),
    })
    if home_from_city:
        missing = (F.col("home_latitude") == 0.0) & (F.col("home_longitude") == 0.0)
        out = out.withColumns({
            "home_latitude": F.when(missing, F.col("lat")).otherwise(F.col("home_latitude")),
            "home_longitude": F.when(missing, F.col("long")).otherwise(F.col("home_longitude")),
        })
    return out


def serve_users(clean: DataFrame, cities: DataFrame | None = None, home_from_city: bool = False) -> DataFrame:
    located = with_city(with_usable_key(clean, "party_id"), cities, home_from_city)
    return located.select("party_id", *_renamed(USER_COLUMNS, USER_CARRIED), *CITY_COLUMNS, *_ordering(clean))


def serve_users_without_city(clean: DataFrame) -> DataFrame:
    """Served users for readers that do not need the city columns."""
    keyed = with_usable_key(clean, "party_id")
    return keyed.select("party_id", *_renamed(USER_COLUMNS, USER_CARRIED), *_ordering(clean))


def serve_merchants(clean: DataFrame) -> DataFrame:
    keyed = with_usable_key(clean, "merchant_id")
    return keyed.select("merchant_id", *_renamed(MERCHANT_COLUMNS, MERCHANT_CARRIED), *_ordering(clean))


def serve_cards(clean: DataFrame) -> DataFrame:
    keyed = with_usable_key(clean, "card_ref")
    return keyed.select("card_ref", *_renamed(CARD_COLUMNS, CARD_CARRIED), *_ordering(clean))
