import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import as_set, column, frame
from tillwatch import schemas as S
from tillwatch.operators import rollups

T = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds):
    return T + dt.timedelta(seconds=seconds)


SCORED = ("event_id string, event_ts string, ts timestamp_ntz, amount_minor int, category string, channel_code string, "
          "fraud_probability double, predicted_fraud int")


def scored(spark, *rows):
    return frame(spark, SCORED, *[{"predicted_fraud": 0, "amount_minor": 0, **row} for row in rows])


def test_windows_are_aligned_to_the_epoch(spark):
    rows = scored(spark, {"ts": at(21)}, {"ts": at(24)}, {"ts": at(25)})
    assert as_set(rollups.tumbling(rows, "ts", F.lit(1), "count")) == [(at(20), 2), (at(25), 1)]


@pytest.mark.parametrize("p, bucket", [(0.0, 0), (0.3, 3), (0.5, 5), (0.999, 9), (1.0, 9), (-0.2, 0), (1.7, 9), (None, 0)])
def test_score_bucket(spark, p, bucket):
    assert spark.range(1).select(rollups.score_bucket(F.lit(p).cast("double")).alias("b")).first()["b"] == bucket


def test_histogram_is_zero_filled_and_complete(spark):
    rows = scored(spark, {"fraud_probability": 0.55}, {"fraud_probability": 0.51}, {"fraud_probability": None})
    assert as_set(rollups.score_histogram(rows)) == [(i, {0: 1, 5: 2}.get(i, 0)) for i in range(10)]
    assert sum(column(rollups.score_histogram(rows, scored_only=True), "n")) == 2
    names = column(rollups.histogram_points(rollups.score_histogram(rows), F.current_timestamp()), "series")
    assert sorted(names) == sorted(f"ts:score:bucket_{i}_{i + 1}" for i in range(10))


def test_daily_counters_count_flagged_rows_only(spark):
    rows = scored(
        spark,
        {"ts": at(0), "predicted_fraud": 1, "category": "FOOD", "channel_code": "POS"},
        {"ts": at(10), "predicted_fraud": 1, "category": None, "channel_code": "POS"},
        {"ts": at(86400), "predicted_fraud": 1, "category": "FOOD", "channel_code": "ECOM"},
        {"ts": at(0), "predicted_fraud": 0, "category": "FOOD", "channel_code": "POS"},
    )
    assert as_set(rollups.fraud_by_category(rows, "ts")) == [
        ("20240101", "FOOD", 1), ("20240101", "UNK", 1), ("20240102", "FOOD", 1)]
    assert as_set(rollups.fraud_by_channel(rows, "ts")) == [("20240101", "POS", 2), ("20240102", "ECOM", 1)]


def test_batch_points_of_an_empty_batch_are_zero(spark):
    points = rollups.batch_points(scored(spark), F.lit(T).cast("timestamp_ntz"))
    assert sorted((r["series"], r["value"]) for r in points.collect()) == sorted(
        (s, 0) for s in (S.SERIES_COUNT, S.SERIES_FRAUD, S.SERIES_PREDICTED, S.SERIES_AMOUNT))


def test_amount_sums_do_not_overflow(spark):
    rows = scored(spark, *[{"ts": at(0), "amount_minor": 2_000_000_000}] * 3)
    points = {r["series"]: r["value"] for r in rollups.series_points(rows, "ts").collect()}
    assert points[S.SERIES_AMOUNT] == 6_000_000_000 and points[S.SERIES_COUNT] == 3


def test_max_rollup_takes_the_busiest_second(spark):
    rows = scored(spark, *[{"ts": at(s)} for s in (0, 0, 0, 1, 4, 5)])
    points = rollups.series_points(rows, "ts")
    assert as_set(rollups.rollup_series(points, S.SERIES_COUNT, "max")) == [(at(0), 3), (at(5), 1)]
    assert as_set(rollups.rollup_series(points, S.SERIES_COUNT, "sum")) == [(at(0), 5), (at(5), 1)]


POINTS = "series string, ts timestamp_ntz, value bigint"


@pytest.mark.parametrize("value, band, shown", [(4, "green", 4), (5, "yellow", 5), (10, "red", 10), (90, "red", 50)])
def test_gauge(spark, value, band, shown):
    points = frame(spark, POINTS, {"series": S.SERIES_FRAUD, "ts": at(0), "value": 1},
                   {"series": S.SERIES_FRAUD, "ts": at(1), "value": value},
                   {"series": S.SERIES_FRAUD, "ts": at(2), "value": None},
                   {"series": S.SERIES_COUNT, "ts": at(3), "value": 7})
    assert as_set(rollups.gauge(points)) == [(value, band, shown)]


def test_reducers_tell_last_from_last_known(spark):
    points = frame(spark, POINTS, {"series": "s", "ts": at(0), "value": 4}, {"series": "s", "ts": at(1), "value": 2},
                   {"series": "s", "ts": at(2), "value": None})
    assert as_set(rollups.reduce_series(points)) == [("s", None, 2, 3.0, 4)]


def test_trailing_and_retention(spark):
    points = frame(spark, POINTS, *[{"series": "a", "ts": at(s), "value": s} for s in (0, 300, 301, 600, 601)],
                   {"series": "b", "ts": at(0), "value": 0})
    assert sorted(column(rollups.trailing(points), "value")) == [301, 600, 601]
    now = F.lit(at(600)).cast("timestamp_ntz")
    assert sorted(column(rollups.trailing(points, now=now), "value")) == [300, 301, 600]
    assert sorted(column(rollups.retained(points), "value")) == [0, 300, 301, 600, 601]
    assert as_set(rollups.retained(points, retention_ms=1000).select("series", "value")) == [
        ("a", 600), ("a", 601), ("b", 0)]


def test_series_are_read_in_time_order(spark):
    points = frame(spark, POINTS, *[{"series": "a", "ts": at(s), "value": s} for s in (5, 1, 3)])
    assert column(rollups.read_series(points, "a"), "value") == [1, 3, 5]


def test_alert_feed_is_capped_exactly(spark):
    rows = scored(spark, *[{"event_id": f"{i:04d}", "event_ts": f"2024-01-01T00:{i % 60:02d}", "predicted_fraud": 1}
                           for i in range(130)])
    feed = rollups.recent_alerts(rollups.alerts(rows), 100)
    assert feed.count() == 100
    assert column(feed, "ts") == sorted(column(feed, "ts"), reverse=True)
    assert "TakeOrderedAndProject" in feed._jdf.queryExecution().executedPlan().toString()


def test_latest_amount(spark):
    rows = scored(spark, {"event_id": "a", "ts": at(1), "amount_minor": 100},
                  {"event_id": "b", "ts": at(1), "amount_minor": 250}, {"event_id": "z", "ts": at(0)})
    assert column(rollups.latest_amount(rows, "ts", "event_id"), "latest_transaction_amount") == [2.5]
