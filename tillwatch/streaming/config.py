"""Where a streaming application reads, writes and keeps its progress."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from tillwatch import schemas as S
from tillwatch.streaming.stores import BatchTable, EntityStore

USER_STORE = StructType([
    StructField("party_id", StringType()),
    StructField("first", StringType()),
    StructField("last", StringType()),
    StructField("gender", StringType()),
    StructField("street", StringType()),
    StructField("state", StringType()),
    StructField("zip", StringType()),
    StructField("job", StringType()),
    StructField("dob", StringType()),
    StructField("age_group", StringType()),
    StructField("income_level", StringType()),
    StructField("city", StringType()),
    StructField("event_ts", StringType()),
    StructField("event_id", StringType()),
    StructField("age", IntegerType()),
    StructField("city_pop", IntegerType()),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
    StructField("home_latitude", DoubleType()),
    StructField("home_longitude", DoubleType()),
    StructField("lat", DoubleType()),
    StructField("long", DoubleType()),
])
MERCHANT_STORE = StructType([
    StructField("merchant_id", StringType()),
    StructField("merchant", StringType()),
    StructField("category", StringType()),
    StructField("merchant_type", StringType()),
    StructField("event_id", StringType()),
    StructField("avg_txn_amount_minor", IntegerType()),
    StructField("is_high_risk", IntegerType()),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
    StructField("merch_lat", DoubleType()),
    StructField("merch_long", DoubleType()),
    StructField("risk_score_merchant", DoubleType()),
])
CARD_STORE = StructType([
    StructField("card_ref", StringType()),
    StructField("party_id", StringType()),
    StructField("cc_last4", StringType()),
    StructField("product_type", StringType()),
    StructField("brand", StringType()),
    StructField("card_age_category", StringType()),
    StructField("event_id", StringType()),
    StructField("days_since_issuance", IntegerType()),
    StructField("is_primary_card", IntegerType()),
    StructField("daily_limit_minor", IntegerType()),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
])
ALERTS = StructType([
    StructField("txn_id", StringType()),
    StructField("category", StringType()),
    StructField("channel", StringType()),
    StructField("ts", StringType()),
    StructField("day", StringType()),
    StructField("amount_minor", LongType()),
])
COUNTERS = StructType([
    StructField("day", StringType()),
    StructField("dimension", StringType()),
    StructField("value", StringType()),
    StructField("n", LongType()),
])
POINTS = StructType([
    StructField("series", StringType()),
    StructField("ts", TimestampType()),
    StructField("value", LongType()),
])
LATEST = StructType([
    StructField("event_ts", StringType()),
    StructField("event_id", StringType()),
    StructField("latest_transaction_amount", DoubleType()),
])
REJECTS = StructType([
    StructField("value", StringType()),
    StructField("missing", ArrayType(StringType())),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
    StructField("event_id", StringType()),
])
SEEN = StructType([
    StructField("event_id", StringType()),
    StructField("event_time", TimestampType()),
])
LATENCIES = POINTS


@dataclass(frozen=True)
class StreamConfig:
    """``locations`` maps a topic to a broker list (``source="kafka"``) or a directory (``"files"``).

    ``run`` names the generation of checkpoints and stores: change it when
    checkpoints are to start afresh, since batch ids start again with them.
    """

    root: str
    locations: dict[str, str]
    source: str = "kafka"
    run: str = "r1"
    threshold: float = S.FRAUD_THRESHOLD
    available_now: bool = False
    trigger_seconds: int | None = None
    deduplicate_within: str | None = None
    hour_from_event_time: bool = False
    count_malformed: bool = False
    reader_options: dict[str, str] = field(default_factory=dict)

    @property
    def base(self) -> str:
        return f"{self.root}/{self.run}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    def table(self, name: str, schema: StructType) -> BatchTable:
        return BatchTable(f"{self.base}/{name}", schema, f"{self.base}/{name}_snapshot")

    @property
    def users(self) -> EntityStore:
        return EntityStore(f"{self.base}/users", "party_id", USER_STORE)

    @property
    def merchants(self) -> EntityStore:
        return EntityStore(f"{self.base}/merchants", "merchant_id", MERCHANT_STORE)

    @property
    def cards(self) -> EntityStore:
        return EntityStore(f"{self.base}/cards", "card_ref", CARD_STORE)

    @property
    def alerts(self) -> BatchTable:
        return self.table("alerts", ALERTS)

    @property
    def counters(self) -> BatchTable:
        return self.table("counters", COUNTERS)

    @property
    def points(self) -> BatchTable:
        return self.table("points", POINTS)

    @property
    def latest(self) -> BatchTable:
        return self.table("latest_amount", LATEST)

    @property
    def rejects(self) -> BatchTable:
        return self.table("rejects", REJECTS)

    @property
    def seen(self) -> BatchTable:
        """Event ids of the batches so far; only kept to drop repeats."""
        return self.table("seen", SEEN)

    @property
    def archive_path(self) -> str:
        return f"{self.base}/archive"

    @property
    def latency_path(self) -> str:
        return f"{self.base}/latency"
