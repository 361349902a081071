import pytest
from pyspark.sql import functions as F

from helpers import as_set, column, frame
from tillwatch.functions import features as X
from tillwatch.functions.cleaners import rounded
from tillwatch.operators import features


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_time_features_count_weekdays_from_monday(spark):
    rows = frame(spark, "t string", {"t": "2024-01-01 13:00:00"}).select(F.col("t").cast("timestamp").alias("t"))
    out = features.with_time_features(rows, "t").select("hour", "day_of_week", "month").first()
    assert tuple(out) == (13, 0, 1)


@pytest.mark.parametrize("dob, expected", [("1990-05-17", 33), ("bad", None), (None, None)])
def test_age_at_transaction(spark, dob, expected):
    assert one(spark, X.age_at(F.lit("2023-11-14 10:00:00").cast("timestamp"), F.lit(dob))) == expected


def test_age_is_left_alone_without_a_birth_date_column(spark):
    rows = frame(spark, "age int", {"age": 7})
    assert column(features.with_age_at(rows), "age") == [7]


@pytest.mark.parametrize("years, expected", [(-5, 0), (50, 50), (140, 100)])
def test_age_from_years(spark, years, expected):
    assert one(spark, X.age_from_years(F.lit(2024), F.lit(2024 - years))) == expected


@pytest.mark.parametrize("age, group", [(24, "18-24"), (25, "25-34"), (34, "25-34"), (64, "55-64"), (65, "65+")])
def test_age_group(spark, age, group):
    assert one(spark, X.age_group(F.lit(age))) == group


@pytest.mark.parametrize("days, name", [(29, "NEW"), (30, "RECENT"), (180, "MODERATE"), (365, "ESTABLISHED")])
def test_card_age_category(spark, days, name):
    assert one(spark, X.card_age_category(F.lit(days))) == name


def test_haversine(spark):
    city_to_city = X.haversine_km(F.lit(10.7769), F.lit(106.7009), F.lit(21.0278), F.lit(105.8342))
    assert one(spark, rounded(city_to_city, 1)) == 1143.6
    missing = X.haversine_km(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0))
    assert one(spark, missing) == 0.0
    antipodes = X.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))
    assert one(spark, antipodes) == pytest.approx(20015.09, abs=0.01)


@pytest.mark.parametrize(
    "text, hour",
    [("2024-01-01T07:30:00+00:00", 7), ("2024-01-01T07:30:00Z", 7), ("2024-01-01T23:59:59.123456+07:00", 23),
     ("nonsense", 0), (None, 0)],
)
def test_hour_of_iso(spark, text, hour):
    assert one(spark, X.hour_of_iso(F.lit(text).cast("string"))) == hour


def test_limit_and_deviation(spark):
    assert one(spark, X.exceeds_limit(F.lit(6000000), F.lit(None).cast("int"))) == 1
    assert one(spark, X.exceeds_limit(F.lit(5000000), F.lit(None).cast("int"))) == 0
    assert one(spark, X.deviation_ratio(F.lit(1500), F.lit(1000))) == 0.5
    assert one(spark, X.deviation_ratio(F.lit(7), F.lit(0))) == 7.0
    assert one(spark, X.deviation_ratio(F.lit(0), F.lit(None).cast("int"))) == 1.0


def test_rule_score_bounds(spark):
    none = X.rule_score(F.lit(0), F.lit(0), F.lit(50.0), F.lit("SMALL"))
    every = X.rule_score(F.lit(1), F.lit(1), F.lit(50.01), F.lit("XLARGE"))
    assert (one(spark, none), one(spark, every)) == (0.005, 0.215)


def test_merchant_risk(spark):
    rows = frame(spark, "mcc_group string", {"mcc_group": "ELEC"}, {"mcc_group": "SERV"}, {"mcc_group": "??"})
    assert as_set(features.with_merchant_risk(rows)) == [("??", 0.1, 0), ("ELEC", 0.15, 0), ("SERV", 0.18, 1)]


def test_identity_functions(spark):
    assert one(spark, X.pan_last4(F.lit("4000123412345678"))) == "5678"
    token = one(spark, X.pan_token(F.lit("4000123412345678")))
    assert token.startswith("h_") and "4000123412345678" not in token
    assert one(spark, X.full_name(F.lit("Nguyen"), F.lit("Van Anh"))) == "Nguyen Van Anh"


def test_align_adds_and_drops(spark):
    rows = frame(spark, "a int, b string, extra int", {"a": 1, "b": "x", "extra": 2})
    out = features.align(rows, ["b", "missing", "a"])
    assert out.columns == ["b", "missing", "a"]
    assert tuple(out.first()) == ("x", None, 1)


def test_feature_frame_coercion_erases_text(spark):
    rows = frame(spark, "category string, amount_major double, trans_date_trans_time timestamp",
                 {"category": "FOOD", "amount_major": 2.0})
    kept = features.feature_frame(rows, ["amt", "category"])
    erased = features.feature_frame(rows, ["amt", "category"], coerce_numeric=True)
    assert tuple(kept.first()) == (2.0, "FOOD")
    assert tuple(erased.first()) == (2.0, None)
