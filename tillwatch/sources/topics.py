"""JSON topics as streaming or batch DataFrames, from Kafka or from files of JSON lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwatch import schemas as S

# What a decoded row keeps of its message, for ordering and for audits.
ENVELOPE = ["message_key", "kafka_partition", "kafka_offset", "kafka_timestamp"]


def kafka_options(servers: str, topic: str, starting: str = "latest", **extra: str) -> dict[str, str]:
    """Reader options; ``starting`` matters on a first run only, a checkpoint overrides it."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


def read_messages(
    spark: SparkSession,
    topic: str,
    source: str = "kafka",
    location: str | None = None,
    streaming: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw messages ``(value, message_key, kafka_partition, kafka_offset, kafka_timestamp)``.

    ``location`` is the broker list for Kafka and a directory with one JSON object
    per line for files, where the envelope columns are null.
    """
    reader = spark.readStream if streaming else spark.read
    options = dict(options or {})
    if source == "kafka":
        starting = "latest" if streaming else "earliest"
        raw = reader.format("kafka").options(**{**kafka_options(location, topic, starting), **options}).load()
        return raw.select(
            F.col("value").cast("string"),
            F.col("key").cast("string").alias("message_key"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"),
        )
    if source == "files":
        raw = reader.schema("value string").options(**options).text(location)
        return raw.select(
            "value",
            F.lit(None).cast("string").alias("message_key"),
            F.lit(None).cast("int").alias("kafka_partition"),
            F.lit(None).cast("bigint").alias("kafka_offset"),
            F.lit(None).cast("timestamp").alias("kafka_timestamp"),
        )
    raise ValueError(f"unknown source {source!r}")


def decode(messages: DataFrame, schema: StructType, envelope: bool = True, raw: bool = False) -> DataFrame:
    """JSON text to typed columns. Unknown fields go; fields that do not parse are null. ``raw`` keeps the text."""
    kept = [name for name in ENVELOPE if name in messages.columns] if envelope else []
    kept += ["value"] if raw else []
    return messages.select(F.from_json("value", schema).alias("data"), *kept).select("data.*", *kept)


def read_topic(spark: SparkSession, topic: str, schema: StructType | None = None, **where) -> DataFrame:
    """Decoded records of a topic; see ``read_messages`` for the other arguments."""
    return decode(read_messages(spark, topic, **where), schema or S.TOPIC_SCHEMAS[topic])


def encode(df: DataFrame, key: str) -> DataFrame:
    """Rows as keyed messages ``(key, value)`` with the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def by_key(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Partition by message key, so that messages of one key stay together and in order."""
    return df.repartition(partitions, key) if partitions else df.repartition(key)
