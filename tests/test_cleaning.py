import pytest
from pyspark.sql import functions as F

from helpers import as_set, column, frame
from tillwatch import schemas as S
from tillwatch.functions.cleaners import banded, rounded, typed_or
from tillwatch.operators import cleaning, quality, validation
from tillwatch.sources import topics


def cleaned(spark, topic, name, *values):
    rows = [{name: value} for value in values]
    return column(cleaning.CLEANERS[topic](frame(spark, S.TOPIC_SCHEMAS[topic], *rows)), name)


@pytest.mark.parametrize(
    "topic, name, values, expected",
    [
        (S.USER_TOPIC, "region_code", [" hcm ", None, "??", ""], ["HCM", "UNK", "??", ""]),
        (S.USER_TOPIC, "address_line", ["  A Street ", None], ["A Street", ""]),
        (S.USER_TOPIC, "income_level", [None, "", "low "], ["MEDIUM", "", "LOW"]),
        (S.USER_TOPIC, "age", [-3, 140, None, 42], [0, 110, 0, 42]),
        (S.USER_TOPIC, "age_group", [None, " 65+"], ["UNKNOWN", "65+"]),
        (S.USER_TOPIC, "home_latitude", [None, 999.0], [0.0, 999.0]),
        (S.MERCHANT_TOPIC, "mcc_group", [None, " food"], ["UNK", "FOOD"]),
        (S.MERCHANT_TOPIC, "merchant_display_name", [None, " x "], ["Merchant", "x"]),
        (S.MERCHANT_TOPIC, "geo_lat", [-95.0, 91.2, None], [-90.0, 90.0, 0.0]),
        (S.MERCHANT_TOPIC, "geo_lon", [-181.0, 180.5, None], [-180.0, 180.0, 0.0]),
        (S.MERCHANT_TOPIC, "risk_score_merchant", [float("nan"), None, 1.5, -0.2], [1.0, 0.0, 1.0, 0.0]),
        (S.MERCHANT_TOPIC, "merchant_type", [None, "both"], ["UNKNOWN", "BOTH"]),
        (S.MERCHANT_TOPIC, "is_high_risk", [1, 0, 2, None], [1, 0, 0, 0]),
        (S.MERCHANT_TOPIC, "avg_txn_amount_minor", [None, -5], [0, -5]),
        (S.CARD_TOPIC, "product_type", ["CREDIT ", " debit", "", None], ["CREDIT", "DEBIT", "", "UNKNOWN"]),
        (S.CARD_TOPIC, "brand", ["mc", "???", None], ["MC", "???", "UNKNOWN"]),
        (S.CARD_TOPIC, "days_since_issuance", [-120, None, 30], [0, 0, 30]),
        (S.CARD_TOPIC, "card_age_category", [None, "new"], ["UNKNOWN", "NEW"]),
        (S.CARD_TOPIC, "is_primary_card", [1, 0, None], [1, 0, 0]),
        (S.CARD_TOPIC, "daily_limit_minor", [-100000, 999999999, None, 500000], [0, 100000000, 0, 500000]),
        (S.TXN_TOPIC, "amount_minor", [-5, None, 1234], [0, 0, 1234]),
        (S.TXN_TOPIC, "amount_sign", [-1, 1, 0, None], [-1, 1, 1, 1]),
        (S.TXN_TOPIC, "currency", [" ", "vnd", None], ["", "VND", "VND"]),
        (S.TXN_TOPIC, "channel_code", ["", None, "ecom"], ["", "POS", "ECOM"]),
        (S.TXN_TOPIC, "entry_mode", [None, "manual "], ["CHIP", "MANUAL"]),
        (S.TXN_TOPIC, "risk_score_online", [float("nan"), None, 1.5, -0.2], [1.0, 0.0, 1.0, 0.0]),
        (S.TXN_TOPIC, "hour_of_day", [None, -1, 27, 5, 23], [0, 0, 0, 5, 23]),
        (S.TXN_TOPIC, "distance_from_home_km", [None, -3.5], [0.0, 3.5]),
        (S.TXN_TOPIC, "amount_deviation_ratio", [None, -0.5], [0.0, 0.5]),
        (S.TXN_TOPIC, "exceeds_daily_limit", [1, 2, None], [1, 0, 0]),
        (S.TXN_TOPIC, "days_since_card_issued", [-1, None, 9], [0, 0, 9]),
    ],
)
def test_rule(spark, topic, name, values, expected):
    assert cleaned(spark, topic, name, *values) == expected


def test_amount_major_comes_from_the_clean_minor_amount(spark):
    rows = frame(spark, S.TXN_SCHEMA, {"amount_minor": 1234}, {"amount_minor": -5}, {"amount_major": -2.0})
    assert column(cleaning.clean_transactions(rows), "amount_major") == [12.34, 0.0, -2.0]


def test_derived_columns_are_recomputed(spark):
    majors = [49.99, 50.0, 199.99, 200.0, 999.99, 1000.0]
    rows = [{"amount_major": m, "amount_category": "STALE", "hour_of_day": h, "is_unusual_hour": 0,
             "event_epoch_sec": 1700000000} for m, h in zip(majors, [None, -1, 27, 5, 6, 23])]
    out = cleaning.clean_transactions(frame(spark, S.TXN_SCHEMA, *rows))
    assert column(out, "amount_category") == ["SMALL", "MEDIUM", "MEDIUM", "LARGE", "LARGE", "XLARGE"]
    assert column(out, "is_unusual_hour") == [1, 1, 1, 1, 0, 0]
    assert column(out.select(F.col("trans_date_trans_time").cast("string").alias("t")), "t")[0] == "2023-11-14 22:13:20"


def test_hour_from_event_time(spark):
    out = cleaning.clean_transactions(
        frame(spark, S.TXN_SCHEMA, {"hour_of_day": 27, "event_epoch_sec": 1700000000}), hour_from_event_time=True
    )
    assert [tuple(r) for r in out.select("hour_of_day", "is_unusual_hour").collect()] == [(22, 0)]


def test_typed_clean(spark):
    rows = frame(spark, "v string", {"v": " 12 "}, {"v": ""}, {"v": None}, {"v": "x1"}, {"v": "\tpad \n"})
    out = rows.select(typed_or("int", -1)(F.col("v")).alias("i"), typed_or("string", "none")(F.col("v")).alias("s"))
    assert column(out, "i") == [12, -1, -1, -1, -1]
    assert column(out, "s") == ["12", "none", "none", "x1", "pad"]
    numbers = frame(spark, "v double", {"v": 12.7}, {"v": None})
    assert column(numbers.select(typed_or("int", 0)(F.col("v")).alias("i")), "i") == [12, 0]


def test_banded_and_rounded(spark):
    rows = frame(spark, "v double", {"v": 1.0}, {"v": 10.0}, {"v": None})
    assert column(rows.select(banded(F.col("v"), [(5, "a"), (None, "b")]).alias("x")), "x") == ["a", "b", "b"]
    values = frame(spark, "v double", {"v": 1.005}, {"v": 2.5}, {"v": 0.1235})
    assert column(values.select(rounded(F.col("v"), 0).alias("x")), "x") == [1.0, 3.0, 0.0]


def test_json_decode_edge_cases(spark):
    texts = ['{"amount_major":"12.34  ","event_id":"a"}', '{"hour_of_day":"","event_id":"b"}',
             '{"amount_minor":3000000000,"event_id":"c"}', "not json", "[1]", "", None,
             '{"event_id":"d","card_pan_hash":"h_1","txn_fraud_probability":0.1}']
    messages = frame(spark, "value string", *[{"value": t} for t in texts])
    out = topics.decode(messages, S.TXN_SCHEMA)
    assert out.columns == S.TXN_SCHEMA.fieldNames()
    assert column(out, "event_id") == ["a", "b", "c", None, None, None, None, "d"]
    assert out.filter("amount_major IS NOT NULL OR hour_of_day IS NOT NULL OR amount_minor IS NOT NULL").count() == 0


def test_required_fields(spark):
    full = {"event_id": "e", "card_ref": "c", "merchant_ref": "m", "amount_minor": 1}
    rows = frame(spark, S.TXN_SCHEMA, full, {**full, "merchant_ref": None}, {**full, "merchant_ref": ""})
    accepted, rejected = validation.split_valid(rows, S.TXN_TOPIC)
    assert column(accepted, "merchant_ref") == ["m", ""]
    assert column(rejected, "merchant_ref") == [None]
    assert column(validation.with_usable_key(rows, "merchant_ref"), "merchant_ref") == ["m"]


def test_quality_profile_counts_noise(spark):
    rows = frame(
        spark, S.CARD_SCHEMA,
        {"product_type": "", "brand": "???", "days_since_issuance": -1, "daily_limit_minor": -1},
        {"product_type": "CREDIT", "brand": None, "days_since_issuance": 1, "daily_limit_minor": 999999999},
    )
    assert as_set(quality.quality_profile(rows, S.CARD_TOPIC).select("rule", "hits")) == sorted([
        ("blank_product_type", 1), ("blank_brand", 1), ("unknown_brand", 1), ("negative_days_since_issuance", 1),
        ("negative_daily_limit", 1), ("over_cap_daily_limit", 1),
    ], key=repr)
