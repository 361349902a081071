"""What happens to a micro-batch. Bodies are DataFrame operations; no rows come to the driver."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tillwatch import schemas as S
from tillwatch.functions.features import day_key
from tillwatch.operators import rollups
from tillwatch.operators.enrich import UNKNOWN_CATEGORY, category_of_row, enrich
from tillwatch.operators.latest import instant, latest_by_key
from tillwatch.operators.validation import flagged_only, missing_fields
from tillwatch.plans import flows
from tillwatch.streaming.config import StreamConfig
from tillwatch.streaming.stores import EntityStore

log = logging.getLogger(__name__)

Handler = Callable[[DataFrame, int], None]

# What the writes of a scored batch read; nothing else is held in memory for them.
REPORTED = [
    "event_id", "event_ts", "trans_date_trans_time", "amount_minor", "channel_code", "category", "fraud_probability",
    "predicted_fraud",
]


def upsert_handler(store: EntityStore, serve: Callable[[DataFrame], DataFrame]) -> Handler:
    """Append the batch's served rows to the entity's change log."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.upsert(serve(batch), batch_id)

    return handle


def _distinct(batch: DataFrame, column: str, name: str) -> DataFrame:
    return batch.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()


def score_batch(
    batch: DataFrame, config: StreamConfig, scorer: flows.Scorer, columns: dict[str, list[str]] | None,
    held: list[DataFrame] | None = None,
) -> DataFrame:
    """The batch with its entities as of now, scored.

    Cards are kept in memory for the join and for the ids of the users if the
    caller gives a list to put them in, and unpersists what is in it.
    """
    spark = batch.sparkSession
    wanted = columns or {}
    cards = config.cards.latest(spark, _distinct(batch, "card_ref", "card_ref"), wanted.get("cards"))
    if held is not None:
        held.append(cards.persist(StorageLevel.MEMORY_AND_DISK))
    users = config.users.latest(spark, _distinct(cards, "party_id", "party_id"), wanted.get("users"))
    merchants = config.merchants.latest(spark, _distinct(batch, "merchant_ref", "merchant_id"), wanted.get("merchants"))
    return scorer(enrich(batch, cards, users, merchants))


def batch_counters(scored: DataFrame) -> DataFrame:
    """Flagged transactions of the batch per UTC day, by category and by channel."""
    values = {"category": category_of_row(), "channel": F.coalesce(F.col("channel_code"), F.lit(UNKNOWN_CATEGORY))}
    flagged = flagged_only(scored).select(
        F.to_date("trans_date_trans_time").alias("_date"), *[value.alias(name) for name, value in values.items()])
    counts = _by_dimension(flagged, "_date")
    return counts.select(day_key(F.col("_date")).alias("day"), "dimension", "value", "n")


def alert_counters(alerts: DataFrame) -> DataFrame:
    """The same from the alerts that a batch has written."""
    return _by_dimension(alerts, "day")


def _by_dimension(flagged: DataFrame, day: str) -> DataFrame:
    names = ("category", "channel")
    both = flagged.groupBy(day, *names).agg(F.count("*").alias("_n"))
    pairs = F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(name).alias("value")) for name in names])
    return both.select(day, "_n", F.inline(pairs)).groupBy(day, "dimension", "value").agg(F.sum("_n").alias("n"))


def daily_counters(counters: DataFrame) -> DataFrame:
    """Totals over the batches' partial counts."""
    return counters.groupBy("day", "dimension", "value").agg(F.sum("n").alias("n"))


def latest_register(latest: DataFrame) -> DataFrame:
    """The overwritten scalar: the last amount any batch has seen."""
    order = F.struct("batch_id", instant("event_ts"), "event_id")
    return latest.agg(F.max_by("latest_transaction_amount", order).alias("latest_transaction_amount"))


def compact(spark: SparkSession, config: StreamConfig) -> None:
    """Compact every store: the last version of each entity, totals, the newest alerts and points within retention."""
    for store in (config.users, config.merchants, config.cards):
        store.compact(spark)
    newest = F.max("batch_id").alias("batch_id")
    config.counters.compact(spark, lambda c: c.groupBy("day", "dimension", "value").agg(F.sum("n").alias("n"), newest))
    config.points.compact(spark, rollups.retained)
    config.alerts.compact(spark, rollups.recent_alerts)
    config.rejects.compact(spark)
    config.latest.compact(spark, lambda rows: rows.orderBy(
        F.desc("batch_id"), instant("event_ts").desc(), F.desc("event_id")).limit(1))
    if config.deduplicate_within:
        span = F.expr(f"interval {config.deduplicate_within}")
        config.seen.compact(spark, lambda seen: seen.filter(
            F.col("event_time").isNull() | (F.col("event_time") >= seen.agg(F.max("event_time")).scalar() - span)))


def transaction_handler(
    config: StreamConfig,
    scorer: flows.Scorer | None = None,
    columns: dict[str, list[str]] | None = flows.FORMULA_COLUMNS,
) -> Handler:
    """Score the batch and write alerts, counters, the latest amount and series points.

    Rows without their required fields are set aside with their message, unless
    malformed rows are to be counted. A failure to write series points is logged and does not fail
    the batch; the writes before it do.
    """
    score = scorer or (lambda df: flows.score_by_formulas(df, config.threshold))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        held, spark = [batch], batch.sparkSession
        try:
            if batch.isEmpty():
                return
            accepted = batch
            if not config.count_malformed:
                # A required amount that was null is 0 once it is clean, so the reader tags rows first.
                accepted = batch.filter("is_valid")
                config.rejects.write(batch.filter("NOT is_valid"), batch_id)
            if config.deduplicate_within:
                with_id = F.col("event_id").isNotNull()
                # Without the batch's own entry, so that a batch that runs again finds the same.
                seen = config.seen.read(batch.sparkSession).filter(F.col("batch_id") < batch_id)
                fresh = unseen(accepted.filter(with_id), seen, config.deduplicate_within)
                accepted = fresh.unionByName(accepted.filter(~with_id))
            scored = score_batch(
                accepted.drop("is_valid", "missing", "value"), config, score, columns, held).select(*REPORTED)
            if config.deduplicate_within:
                held.append(scored.persist(StorageLevel.MEMORY_AND_DISK))  # read for the alerts and for the event ids

            # The totals are taken by the pass that writes the alerts; nothing else reads the scored rows.
            metrics = Observation(f"batch {batch_id}")
            day = day_key(F.col("trans_date_trans_time")).alias("day")
            config.alerts.write(rollups.alerts(rollups.observed(scored, metrics), day), batch_id)
            config.counters.write(alert_counters(config.alerts.read_batch(spark, batch_id)), batch_id)
            if config.deduplicate_within:
                ids = scored.select("event_id", F.col("trans_date_trans_time").alias("event_time"))
                config.seen.write(ids.filter("event_id IS NOT NULL"), batch_id)
            totals = rollups.observed_totals(spark, metrics)
            amount = (F.col("last.amount_minor") / 100.0).alias("latest_transaction_amount")
            config.latest.write(totals.select("last.event_ts", "last.event_id", amount), batch_id)
            try:
                now = F.current_timestamp()
                points = rollups.batch_points(scored, now, totals=totals).unionByName(
                    rollups.histogram_points(rollups.totals_histogram(totals), now)
                )
                config.points.write(points, batch_id)
            except Exception:
                log.exception("batch %s: series points were not written", batch_id)
        finally:
            for df in held:
                df.unpersist()

    return handle


def tag_before_cleaning(raw: DataFrame) -> DataFrame:
    """Name the required fields that transactions lack, while that can still be seen."""
    return raw.withColumn("missing", missing_fields(S.TXN_TOPIC)).withColumn("is_valid", F.size("missing") == 0)


ARRIVAL = ("trans_date_trans_time", "kafka_partition", "kafka_offset", "value")


def unseen(
    batch: DataFrame, seen: DataFrame, within: str, time: str = ARRIVAL[0], order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """One row of each event id that ``seen`` (event_id, event_time) does not have within a span before the batch.

    Late rows stay, however late.
    """
    once = latest_by_key(batch, "event_id", order)
    earliest = batch.agg(F.min(time)).scalar() - F.expr(f"interval {within}")
    near = seen.filter(F.col("event_time").isNull() | (F.col("event_time") >= earliest))
    return once.join(near.select("event_id").distinct(), "event_id", "left_anti")
