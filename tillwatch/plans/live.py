"""Registered queries that run streams over the batch tables, write stores, and read them back."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, functions as F

from tillwatch import schemas as S
from tillwatch.operators import bloom, corrections as C, cutoff, dyadic, enrich as E, offsets, rollups, variants
from tillwatch.operators.joins import asof_lookup, lookup
from tillwatch.plans import queries as base
from tillwatch.plans.dataset import Dataset
from tillwatch.plans.registry import query
from tillwatch.sources import bucketed, tables, topics
from tillwatch.sources.workspace import new_folder, shuffles_dropped, tasks_of, written
from tillwatch.streaming import handlers, queries as streams, state
from tillwatch.streaming.config import StreamConfig
from tillwatch.streaming.series import SeriesStore
from tillwatch.streaming.stores import BatchTable


# ------------------------------------------------------------------------ state
def _in_parts(df: DataFrame, folder: str, parts: list[int], of: int, by: str) -> None:
    """Write some of ``of`` parts of a table into a folder, a file each."""
    part = F.pmod(F.xxhash64(by), F.lit(of))
    for n in parts:
        df.filter(part == n).coalesce(1).write.mode("append").parquet(folder)


@query
def latest_cards_from_state(d: Dataset) -> DataFrame:
    """Card versions in three micro-batches, the query stopped and started again before the third."""
    versions = tables.raw_card_versions(d.spark, d.directory).drop("valid_from")
    folder = new_folder(d.spark, "card_versions")
    session = state.state_session(d.spark)
    for parts in ([0, 1], [2]):
        _in_parts(versions, f"{folder}/in", parts, 3, "event_id")
        rows = session.readStream.schema(versions.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        state.start_latest(rows, "card_ref", ["event_ts", "event_id"], f"{folder}/checkpoint").awaitTermination()
    return state.read_latest(d.spark, f"{folder}/checkpoint", "card_ref")


# ---------------------------------------------------------------------- metrics
def _observed(d: Dataset) -> DataFrame:
    """Totals of the scored events, taken by the pass that writes their alerts."""
    metrics = Observation("events")
    scored = rollups.observed(base._formula_scored(d), metrics)
    written(rollups.alerts(scored), "alerts")
    return rollups.observed_totals(d.spark, metrics)


@query
def observed_metrics(d: Dataset) -> DataFrame:
    totals = _observed(d)
    return rollups.batch_points(totals, F.current_timestamp(), totals=totals).select("series", "value")


@query
def observed_histogram(d: Dataset) -> DataFrame:
    return rollups.totals_histogram(_observed(d))


# --------------------------------------------------------------------- recovery
class FailsOnce(BatchTable):
    """Counters whose first write fails, after the batch's alerts were written."""

    def write(self, df: DataFrame, batch_id: int) -> None:
        mark = BatchTable(f"{self.path}_failed", self.schema)
        if not mark.tried(df.sparkSession):
            mark.write(df.limit(0), 0)
            raise RuntimeError("failed between two writes")
        super().write(df, batch_id)


class FailingConfig(StreamConfig):
    @property
    def counters(self) -> BatchTable:
        table = super().counters
        return FailsOnce(table.path, table.schema, table.snapshot_path)


MESSAGES_IN_FILE = 200_000
TXN_BATCHES = 3


def _files(rows: DataFrame, batches: int = 1) -> int:
    """How many files to write messages into: as many in each batch, none with many more than ``MESSAGES_IN_FILE``."""
    return batches * max(1, -(-rows.count() // (batches * MESSAGES_IN_FILE)))


@query
def counters_after_failure(d: Dataset) -> DataFrame:
    """Events as JSON files through the streams, with a failure between two writes and a restart from the checkpoint."""
    folder = new_folder(d.spark, "stream")
    readers = {S.USER_TOPIC: tables.raw_users, S.MERCHANT_TOPIC: tables.raw_merchants, S.CARD_TOPIC: tables.raw_cards,
               S.TXN_TOPIC: tables.raw_event_txns}
    files = {}
    for topic, reader in readers.items():
        rows = reader(d.spark, d.directory)
        fields = [name for name in S.TOPIC_SCHEMAS[topic].fieldNames() if name in rows.columns]
        messages = topics.encode(rows.select(*fields), S.TOPIC_KEYS[topic]).select("value")
        files[topic] = _files(rows, TXN_BATCHES if topic == S.TXN_TOPIC else 1)
        messages.repartition(files[topic]).write.text(f"{folder}/in/{topic}")
    config = FailingConfig(f"{folder}/app", {t: f"{folder}/in/{t}" for t in readers}, source="files", available_now=True,
                           count_malformed=True)
    # An entity is one micro-batch, whatever its files; transactions are ``TXN_BATCHES``.
    each = {topic: n // (TXN_BATCHES if topic == S.TXN_TOPIC else 1) for topic, n in files.items()}
    configs = {t: replace(config, reader_options={"maxFilesPerTrigger": str(n)}) for t, n in each.items()}
    entities = (S.USER_TOPIC, S.MERCHANT_TOPIC, S.CARD_TOPIC)
    streams.wait({topic: streams.start_upserts(d.spark, configs[topic], topic) for topic in entities}, poll_seconds=0.1)
    try:
        streams.wait({S.TXN_TOPIC: streams.start_transactions(d.spark, configs[S.TXN_TOPIC])}, poll_seconds=0.1)
    except StreamingQueryException:
        streams.wait({S.TXN_TOPIC: streams.start_transactions(d.spark, configs[S.TXN_TOPIC])}, poll_seconds=0.1)
    return handlers.daily_counters(config.counters.read(d.spark))


# ------------------------------------------------------------------ corrections
CODEC = "zstd"  # of tables as large as the lines
SORTED_TWICE = 32 * 2**20  # of a shuffle, which one task sorts for a join and again by month


@query
def asof_corrected(d: Dataset) -> DataFrame:
    """Lines with the card version in force, a tenth of the versions known only after a first result."""
    with shuffles_dropped(d.spark):
        txns = d.line_txns().select("event_id", "card_ref", "ts", "amount_minor")
        stored = new_folder(d.spark, "facts")
        months = txns.withColumn(C.BUCKET, F.date_trunc("month", "ts"))
        # Tasks that join the lines with their orders write a file for each month, which spares shuffling them by month.
        with tasks_of(d.spark, SORTED_TWICE):
            months.write.partitionBy(C.BUCKET).parquet(stored, compression=CODEC)
        facts = d.spark.read.parquet(stored).withColumn(C.BUCKET, F.col(C.BUCKET).cast("timestamp"))
        versions = d.card_versions().select(
            "card_ref", "valid_from", F.col("event_id").alias("card_event_id"), "daily_limit_minor")
        is_late = F.pmod(F.xxhash64("card_event_id"), F.lit(10)) == 0
        known, late = versions.filter(~is_late), versions.filter(is_late)
        keys = facts.select("card_ref")
        first = written(asof_lookup(
            facts.drop(C.BUCKET), known, "card_ref", "ts", "valid_from", ["card_event_id"], bucket="month", skew_from=keys),
            "first", CODEC)
        changed = written(C.changed_intervals(known, late, "card_ref", "valid_from", ["card_event_id"]), "changed", CODEC)
        named = C.changed_partitions(changed, "card_ref", "month", facts.agg(F.max("ts")))
        near = facts.filter(F.col(C.BUCKET).isin(named)) if named else facts.limit(0)
        # Lines of a card are together in the first result, so it is cheaper to count them there.
        found = C.corrections(near, changed, "card_ref", "ts", skew_from=first.select("card_ref"))
        again = written(found.withColumnRenamed(C.FROM, "valid_from"), "corrections", CODEC)
        # Most lines were not looked up again: a filter tells them, and they are not shuffled.
        return bloom.orphans(first, again, "event_id", "event_id").unionByName(again)


# --------------------------------------------------------------------- buckets
BUCKETS = 8


@query
def enrich_txn_bucketed(d: Dataset) -> DataFrame:
    """The lookups from tables in buckets by key: the entities are written once, and not shuffled again."""
    txns = d.event_txns()
    cards, users, merchants = d.entities()
    found = {"card_found": F.lit(True), "user_found": F.lit(True), "merchant_found": F.lit(True)}
    # A card's user is joined when the card is written; columns of the transaction or the nearer entity win.
    cards = cards.withColumn("card_found", found["card_found"]).drop(*E.ORDER_COLUMNS)
    users = users.withColumn("user_found", found["user_found"]).drop(*E.ORDER_COLUMNS)
    users = users.drop(*[c for c in users.columns if c in cards.columns and c != "party_id"])
    holders = lookup(cards, users, "party_id")
    merchants = merchants.withColumn("merchant_found", found["merchant_found"]).drop(*E.ORDER_COLUMNS)
    merchants = merchants.withColumnRenamed("merchant_id", "merchant_ref")
    held = {"card_ref": holders, "merchant_ref": merchants}
    out = txns
    for key, entity in held.items():
        entity = entity.drop(*[c for c in entity.columns if c in out.columns and c != key])
        table = bucketed.write_bucketed(entity, key, BUCKETS, key)
        out = bucketed.join_bucketed(out, d.spark, table, key)
    flags = {name: F.coalesce(name, F.lit(False)) for name in found}
    return out.withColumns(flags).select(*base._enriched_columns())


# ---------------------------------------------------------------------- series
def _series_store(d: Dataset) -> SeriesStore:
    """The points of the scored events, the days in two batches, the second of them written twice."""
    store = SeriesStore(new_folder(d.spark, "series"), "day")
    points = written(base._points(d), "points")
    even = F.datediff(F.col("ts"), F.lit("1970-01-01")) % 2 == 0
    for batch_id, part in ((0, points.filter(even)), (1, points.filter(~even)), (1, points.filter(~even))):
        store.write(part, batch_id)
    return store


@query
def stored_series_range(d: Dataset) -> DataFrame:
    """A day and a half of one stored series."""
    store = _series_store(d)
    first = store.read(d.spark).agg(F.min("ts")).first()[0]
    rows = store.read(d.spark, S.SERIES_AMOUNT, first + timedelta(hours=36), first + timedelta(hours=72))
    return rows.select("ts", "value")


@query
def stored_retention(d: Dataset) -> DataFrame:
    """Stored series after the days out of retention were dropped."""
    store = _series_store(d)
    store.retain(d.spark, S.SERIES_RETENTION_MS)
    return rollups.retained(store.read(d.spark))


@query
def dyadic_ranges(d: Dataset) -> DataFrame:
    """Sum, maximum and last value of each series over a range for each nation, from nodes at powers of two."""
    folder = new_folder(d.spark, "nodes")
    dyadic.nodes(base._points(d)).write.partitionBy("level").parquet(folder)
    stored = d.spark.read.parquet(folder)
    start = stored.filter("level = 0").agg(F.min("last_unit")).scalar()
    nations = tables.read_table(d.spark, d.directory, "nation").select(F.col("n_nationkey").cast("bigint").alias("range_id"))
    series = stored.filter(f"level = {dyadic.LEVELS}").select("series").distinct()
    ranges = nations.join(F.broadcast(series)).select(
        "range_id", "series", (start + F.col("range_id") * 40_003).alias("_from"),
        (start + F.col("range_id") * 40_003 + (F.col("range_id") + 1) * 30_011).alias("_to"))
    return dyadic.over_ranges(stored, ranges)


# --------------------------------------------------- filters, offsets, cut-offs
@query
def orphan_cards_filtered(d: Dataset) -> DataFrame:
    """Transactions without a card, most others told by a filter before any shuffle."""
    found = bloom.orphans(d.event_txns(), d.cards(columns=[]), "card_ref", "card_ref")
    return found.select("event_id", "card_ref")


def _offsets(d: Dataset) -> DataFrame:
    """Order lines as messages: line numbers as partitions, the first with the most; keys as offsets, with planted faults."""
    lines = tables.read_table(d.spark, d.directory, "lineitem").select(
        F.col("l_linenumber").cast("int").alias("kafka_partition"), F.col("l_orderkey").cast("bigint").alias("kafka_offset"))
    again = lines.filter("kafka_offset % 97 = 5")
    return lines.filter("kafka_offset % 50 NOT IN (7, 8)").unionByName(again)


@query
def offset_faults(d: Dataset) -> DataFrame:
    """Ranges of offsets that are missing or came more than once."""
    return offsets.faults(_offsets(d), block=2048)


def _labelled(d: Dataset) -> DataFrame:
    return base._rule_scored_lines(d).select("fraud_probability", (F.col("amount_sign") == -1).cast("int").alias("label"))


@query
def rule_score_auc(d: Dataset) -> DataFrame:
    """Area under the curve of the rule score for reversals, and the best cut-off."""
    return cutoff.auc_and_cutoff(_labelled(d), "fraud_probability", "label").select(
        F.floor(F.col("auc") * 1_000_000).alias("auc_millionths"), "cutoff", "true_positives", "false_positives")


@query
def undeclared_fields(d: Dataset) -> DataFrame:
    """Fields of the messages as they came, with their types."""
    return variants.field_types(tables.event_messages(d.spark, d.directory), "value")


@query
def mistyped_fields(d: Dataset) -> DataFrame:
    """Values whose type is not the declared one."""
    return variants.mistyped(tables.event_messages(d.spark, d.directory), "value", S.TXN_SCHEMA, ["message_id"])
