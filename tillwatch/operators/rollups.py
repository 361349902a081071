"""Counters, histograms, series points, windowed rollups and the alert feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillwatch import schemas as S
from tillwatch.functions import features as X
from tillwatch.functions.cleaners import banded
from tillwatch.operators.enrich import UNKNOWN_CATEGORY, category_of_row
from tillwatch.operators.latest import instant
from tillwatch.operators.validation import flagged_only
from tillwatch.sources.static import local_table

AGGREGATES = {"sum": F.sum, "max": F.max, "count": F.count, "avg": F.avg}


# -------------------------------------------------------------------- counters
def _txn_totals() -> list[Column]:
    return [
        F.count("*").alias(S.SERIES_COUNT),
        F.sum(F.col("predicted_fraud").cast("bigint")).alias(S.SERIES_PREDICTED),
        F.sum(F.col("amount_minor").cast("bigint")).alias(S.SERIES_AMOUNT),
    ]


def _as_points(totals: DataFrame, ts: Column, *carried: str) -> DataFrame:
    """One row per series from one row per batch. The two fraud series are the same number."""
    values = {
        S.SERIES_COUNT: S.SERIES_COUNT,
        S.SERIES_FRAUD: S.SERIES_PREDICTED,
        S.SERIES_PREDICTED: S.SERIES_PREDICTED,
        S.SERIES_AMOUNT: S.SERIES_AMOUNT,
    }
    pairs = F.array(*[
        F.struct(F.lit(series).alias("series"), F.coalesce(F.col(f"`{source}`"), F.lit(0)).alias("value"))
        for series, source in values.items()
    ])
    return totals.select(*carried, ts.alias("ts"), F.inline(pairs)).select("series", "ts", "value", *carried)


def _batch_totals(probability: str) -> list[Column]:
    bucket = score_bucket(F.col(probability))
    last = F.max_by(F.struct("event_ts", "event_id", "amount_minor"), F.struct(instant("event_ts"), "event_id"))
    return [*_txn_totals(), last.alias("last"),
            *[F.count_if(bucket == i).alias(f"bucket_{i}") for i in range(S.SCORE_BUCKETS)]]


def batch_totals(scored: DataFrame, probability: str = "fraud_probability") -> DataFrame:
    """All that is reported of a batch as a whole, in one pass and one row: totals, score buckets, last transaction."""
    return scored.agg(*_batch_totals(probability))


def observed(scored: DataFrame, metrics: Observation, probability: str = "fraud_probability") -> DataFrame:
    """``scored``, whose totals are taken by the first action that reads all of it."""
    return scored.observe(metrics, *_batch_totals(probability))


def observed_totals(spark: SparkSession, metrics: Observation) -> DataFrame:
    """What ``batch_totals`` gives, from metrics that an action has taken; one row."""
    values = metrics.get
    last = values["last"]
    fields = [StructField(name, LongType()) for name in (S.SERIES_COUNT, S.SERIES_PREDICTED, S.SERIES_AMOUNT)]
    buckets = [StructField(f"bucket_{i}", LongType()) for i in range(S.SCORE_BUCKETS)]
    own = [StructField("event_ts", StringType()), StructField("event_id", StringType()), StructField("amount_minor", LongType())]
    row = local_table(
        spark, [(*[values[f.name] for f in [*fields, *buckets]], *([None] * 3 if last is None else last))],
        StructType([*fields, *buckets, *own]))
    return row.select(*[f"`{f.name}`" for f in [*fields, *buckets]], F.struct(*[f.name for f in own]).alias("last"))


def batch_points(scored: DataFrame, ts: Column, *carried: str, totals: DataFrame | None = None) -> DataFrame:
    """The four transaction series for one batch, stamped ``ts``; from its ``totals``, if they are there already."""
    if totals is None:
        totals = scored.groupBy(*carried).agg(*_txn_totals()) if carried else scored.agg(*_txn_totals())
    return _as_points(totals, ts, *carried)


def totals_histogram(totals: DataFrame) -> DataFrame:
    """The score histogram of ``batch_totals``."""
    pairs = [F.struct(F.lit(i).alias("bucket"), F.col(f"bucket_{i}").alias("n")) for i in range(S.SCORE_BUCKETS)]
    return totals.select(F.inline(F.array(*pairs)))


def series_points(scored: DataFrame, ts: str, width: str = "1 second") -> DataFrame:
    """The four transaction series as one point per event-time interval."""
    totals = scored.groupBy(F.window(ts, width).alias("w")).agg(*_txn_totals())
    return _as_points(totals, F.col("w.start"))


def daily_counter(scored: DataFrame, ts: str, value: Column, name: str) -> DataFrame:
    """Flagged transactions per UTC day and value. Groups by date, formats the few results."""
    counts = flagged_only(scored).groupBy(F.to_date(ts).alias("_date"), value.alias(name)).agg(F.count("*").alias("n"))
    return counts.select(X.day_key(F.col("_date")).alias("day"), name, "n")


def fraud_by_category(scored: DataFrame, ts: str) -> DataFrame:
    return daily_counter(scored, ts, category_of_row(), "category")


def fraud_by_channel(scored: DataFrame, ts: str) -> DataFrame:
    return daily_counter(scored, ts, F.coalesce(F.col("channel_code"), F.lit(UNKNOWN_CATEGORY)), "channel")


def score_bucket(probability: Column) -> Column:
    last = S.SCORE_BUCKETS - 1
    index = F.floor(F.coalesce(probability, F.lit(0.0)) * S.SCORE_BUCKETS)
    return F.least(F.greatest(index, F.lit(0)), F.lit(last)).cast("int")


def score_histogram(
    scored: DataFrame, probability: str = "fraud_probability", scored_only: bool = False
) -> DataFrame:
    """Ten score buckets, empty ones included.

    Every transaction is in one of them, so the counts add up to the number of
    transactions: one that was not scored, for want of a card, is in bucket 0,
    unless ``scored_only`` leaves it out.
    """
    buckets = scored.sparkSession.range(0, S.SCORE_BUCKETS, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    rows = scored.filter(F.col(probability).isNotNull()) if scored_only else scored
    counts = rows.groupBy(score_bucket(F.col(probability)).alias("bucket")).agg(F.count("*").alias("n"))
    # At most one row per bucket on either side.
    return buckets.join(F.broadcast(counts), "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def histogram_points(histogram: DataFrame, ts: Column) -> DataFrame:
    name = F.concat(F.lit(S.SCORE_BUCKET_PREFIX), F.col("bucket"), F.lit("_"), F.col("bucket") + 1)
    return histogram.select(name.alias("series"), ts.alias("ts"), F.col("n").cast("bigint").alias("value"))


def latest_amount(txns: DataFrame, *order_by: str) -> DataFrame:
    """Amount of the last transaction in major units, as one row."""
    return txns.agg(
        F.max_by(X.major_units(F.col("amount_minor")), F.struct(*order_by)).alias("latest_transaction_amount")
    )


# --------------------------------------------------------------------- rollups
def tumbling(df: DataFrame, ts: str, value: Column, how: str, width: str = S.ROLLUP_WIDTH) -> DataFrame:
    """``(bucket_start, value)`` per tumbling event-time window; empty windows give no row."""
    return (
        df.groupBy(F.window(ts, width).alias("w"))
        .agg(AGGREGATES[how](value).alias("value"))
        .select(F.col("w.start").alias("bucket_start"), "value")
    )


def rollup_series(points: DataFrame, series: str, how: str, width: str = S.ROLLUP_WIDTH) -> DataFrame:
    """A tumbling rollup of one stored series."""
    return tumbling(points.filter(F.col("series") == series), "ts", F.col("value"), how, width)


def last_values(points: DataFrame, width: str = "1 millisecond") -> DataFrame:
    """Last point of each series within each interval."""
    return (
        points.groupBy("series", F.window("ts", width).alias("w"))
        .agg(F.max_by("value", "ts").alias("value"))
        .select("series", F.col("w.start").alias("bucket_start"), "value")
    )


def reduce_series(points: DataFrame) -> DataFrame:
    """The panel reducers: last, last that is not null, mean and maximum per series."""
    return points.groupBy("series").agg(
        F.max_by("value", "ts").alias("last"),
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col("ts"))).alias("last_not_null"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
    )


def gauge(points: DataFrame, series: str = S.SERIES_FRAUD) -> DataFrame:
    """Latest value of a series, its colour band and its capped display value."""
    known = points.filter((F.col("series") == series) & F.col("value").isNotNull())
    return known.agg(F.max_by("value", "ts").alias("value")).select(
        "value",
        banded(F.col("value"), S.GAUGE_BANDS).alias("band"),
        F.least("value", F.lit(S.GAUGE_MAX)).alias("display_value"),
    )


def trailing(
    df: DataFrame, ts: str = "ts", span: str = S.TRAILING_VIEW, now: Column | None = None,
    newest_from: DataFrame | None = None,
) -> DataFrame:
    """Rows of the last ``span`` up to ``now``, by default up to the newest row.

    ``newest_from`` is a cheaper DataFrame with the same newest ``ts`` to look for it in.
    """
    newest = df if newest_from is None else newest_from
    until = newest.agg(F.max(ts)).scalar() if now is None else now
    return df.filter((F.col(ts) >= until - F.expr(f"interval {span}")) & (F.col(ts) <= until))


def retained(
    points: DataFrame, retention_ms: int = S.SERIES_RETENTION_MS, newest_from: DataFrame | None = None
) -> DataFrame:
    """Drop points older than the retention, counted from the newest point of each series.

    Where all series end at the same moment, ``newest_from`` is a cheaper DataFrame with it as its newest ``ts``.
    """
    oldest = F.expr(f"interval {retention_ms} milliseconds")
    if newest_from is not None:
        return points.filter(F.col("ts") >= newest_from.agg(F.max("ts")).scalar() - oldest)
    newest = points.groupBy("series").agg(F.max("ts").alias("_newest"))
    joined = points.join(newest, "series")
    oldest = F.col("_newest") - oldest
    return joined.filter(F.col("ts") >= oldest).drop("_newest")


def read_series(points: DataFrame, series: str) -> DataFrame:
    """All points of one series in time order."""
    return points.filter(F.col("series") == series).select("ts", "value").orderBy("ts")


# ---------------------------------------------------------------------- alerts
def alerts(scored: DataFrame, *carried: str) -> DataFrame:
    return flagged_only(scored).select(
        F.col("event_id").alias("txn_id"),
        F.col("amount_minor").cast("bigint").alias("amount_minor"),
        category_of_row().alias("category"),
        F.coalesce(F.col("channel_code"), F.lit(UNKNOWN_CATEGORY)).alias("channel"),
        F.col("event_ts").alias("ts"),
        *carried,
    )


def recent_alerts(feed: DataFrame, length: int = S.ALERT_FEED_LENGTH) -> DataFrame:
    """The newest alerts by the moment they name, exactly ``length`` of them if there are as many."""
    return feed.orderBy(instant("ts").desc(), F.desc("txn_id")).limit(length)
