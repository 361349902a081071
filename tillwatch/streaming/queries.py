"""The streaming queries of the application."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tillwatch import schemas as S
from tillwatch.functions.features import day_key
from tillwatch.operators import cleaning, serving
from tillwatch.operators.enrich import category_of_row
from tillwatch.plans import flows
from tillwatch.sources import topics
from tillwatch.streaming import handlers
from tillwatch.streaming.config import StreamConfig

log = logging.getLogger(__name__)


def messages(spark: SparkSession, config: StreamConfig, topic: str) -> DataFrame:
    return topics.read_messages(
        spark, topic, source=config.source, location=config.locations[topic], options=config.reader_options
    )


def records(spark: SparkSession, config: StreamConfig, topic: str) -> DataFrame:
    return topics.decode(messages(spark, config, topic), S.TOPIC_SCHEMAS[topic])


def _writer(df: DataFrame, config: StreamConfig, name: str, mode: str = "append") -> DataStreamWriter:
    writer = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", config.checkpoint(name))
    if config.available_now:
        return writer.trigger(availableNow=True)
    if config.trigger_seconds:
        return writer.trigger(processingTime=f"{config.trigger_seconds} seconds")
    return writer


# ------------------------------------------------------------- event-time extras
def with_watermark(df: DataFrame, delay: str, ts: str = "trans_date_trans_time") -> DataFrame:
    return df.withWatermark(ts, delay)


def deduplicated(df: DataFrame, delay: str, ts: str = "trans_date_trans_time") -> DataFrame:
    """Drop repeats of an event id that arrive within the watermark.

    Rows later than the watermark go, too, and rows without an id count as repeats
    of each other, so part those first. The application uses ``handlers.unseen``.
    """
    return with_watermark(df, delay, ts).dropDuplicatesWithinWatermark(["event_id"])


def windowed_totals(txns: DataFrame, delay: str, width: str = S.ROLLUP_WIDTH) -> DataFrame:
    """Count and amount per event-time window of a stream; late rows count until the watermark."""
    return (
        with_watermark(txns, delay)
        .groupBy(F.window("trans_date_trans_time", width).alias("w"))
        .agg(F.count("*").alias("n"), F.sum(F.col("amount_minor").cast("bigint")).alias("amount_minor"))
        .select(F.col("w.start").alias("bucket_start"), "n", "amount_minor")
    )


def running_daily_counts(scored: DataFrame, delay: str, by: str) -> DataFrame:
    """Flagged transactions per day as running state, for update mode; ``by`` is a column name."""
    value = category_of_row() if by == "category" else F.col(by)
    day = F.window("trans_date_trans_time", "1 day").alias("w")
    counts = with_watermark(scored.filter("predicted_fraud = 1"), delay).groupBy(day, value.alias(by))
    return counts.agg(F.count("*").alias("n")).select(day_key(F.col("w.start")).alias("day"), by, "n")


# ------------------------------------------------------------------ the queries
def start_upserts(spark: SparkSession, config: StreamConfig, topic: str) -> StreamingQuery:
    store, serve = {
        S.USER_TOPIC: (config.users, serving.serve_users),
        S.MERCHANT_TOPIC: (config.merchants, serving.serve_merchants),
        S.CARD_TOPIC: (config.cards, serving.serve_cards),
    }[topic]
    clean = cleaning.CLEANERS[topic](records(spark, config, topic))
    return _writer(clean, config, topic).foreachBatch(handlers.upsert_handler(store, serve)).start()


def start_transactions(
    spark: SparkSession,
    config: StreamConfig,
    scorer: flows.Scorer | None = None,
    columns: dict[str, list[str]] | None = flows.FORMULA_COLUMNS,
) -> StreamingQuery:
    """Score transactions. Repeats are dropped by the handler, which loses neither malformed nor late rows."""
    decoded = topics.decode(messages(spark, config, S.TXN_TOPIC), S.TXN_SCHEMA, raw=True)
    clean = cleaning.clean_transactions(handlers.tag_before_cleaning(decoded), config.hour_from_event_time)
    handler = handlers.transaction_handler(config, scorer, columns)
    return _writer(clean, config, S.TXN_TOPIC).foreachBatch(handler).start()


def start_archive(spark: SparkSession, config: StreamConfig, name: str = "archive") -> StreamingQuery:
    """Keep the raw messages of all topics as they came, by topic and by the day they arrived.

    One query for all topics, since a file sink has a single writer.
    """
    raw = reduce(
        DataFrame.unionByName,
        [messages(spark, config, topic).withColumn("topic", F.lit(topic)) for topic in S.TOPIC_SCHEMAS],
    )
    arrived = F.coalesce("kafka_timestamp", F.current_timestamp())
    writer = _writer(raw.withColumn("day", F.to_date(arrived)), config, name)
    return writer.format("parquet").partitionBy("topic", "day").option("path", config.archive_path).start()


def publish(
    df: DataFrame, config: StreamConfig, name: str, key: str, target: str, topic: str | None = None
) -> StreamingQuery:
    """Write rows as keyed JSON messages, to Kafka if a topic is given and else to text files."""
    out = topics.encode(df, key)
    if topic is not None:
        writer = _writer(out, config, name).format("kafka")
        writer = writer.option("kafka.bootstrap.servers", target).option("topic", topic)
    else:
        writer = _writer(out.select("value"), config, name).format("text").option("path", target)
    return writer.start()


def start_all(
    spark: SparkSession,
    config: StreamConfig,
    scorer: flows.Scorer | None = None,
    columns: dict[str, list[str]] | None = flows.FORMULA_COLUMNS,
    archive: bool = False,
) -> dict[str, StreamingQuery]:
    """The three entity queries and the transaction query, each with its own checkpoint."""
    started = {topic: start_upserts(spark, config, topic) for topic in (S.USER_TOPIC, S.MERCHANT_TOPIC, S.CARD_TOPIC)}
    started[S.TXN_TOPIC] = start_transactions(spark, config, scorer, columns)
    if archive:
        started["archive"] = start_archive(spark, config)
    return started


def wait(started: dict[str, StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Block until all queries end. The first failure stops the others and is raised."""
    try:
        while running := [q for q in started.values() if q.isActive]:
            _raise_failure(started)
            running[0].awaitTermination(poll_seconds)
        _raise_failure(started)
    finally:
        for query in started.values():
            if query.isActive:
                query.stop()


def _raise_failure(started: dict[str, StreamingQuery]) -> None:
    for name, ended in started.items():
        failure = ended.exception()
        if failure is not None:
            log.error("streaming query %s failed", name)
            raise failure
