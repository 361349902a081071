"""Latest row per key as state of a streaming query, and reads of that state.

The state is the store: it holds one row for each key, a micro-batch touches the
keys it has, and recovery is the checkpoint's. RocksDB keeps it on the
executors' disks, so it may outgrow memory, and writes what has changed to the
checkpoint. It is read back as a table by Spark's state data source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.session import RUNTIME_CONF

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
KEPT, ORDER = "valueWithExtremumOrdering", "extremumOrdering"  # as max_by names its state


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of its own for stateful queries, so that their settings change nothing else.

    ``partitions`` is the number of state partitions, which stays with the checkpoint.
    """
    session = spark.newSession()
    settings = {**RUNTIME_CONF, **STATE_CONF}
    settings["spark.sql.shuffle.partitions"] = str(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def latest_of_stream(rows: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """The row of each key with the greatest ``order_by`` values so far, for update mode.

    Rows without a key are left out. A micro-batch combines its rows of a key
    before they are shuffled, so a hot key sends one row per task.
    """
    payload = [name for name in rows.columns if name != key]
    kept = F.max_by(F.struct(*payload), F.struct(*order_by)).alias("_kept")
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(kept).select(key, "_kept.*").select(*rows.columns)


def start_latest(
    rows: DataFrame, key: str, order_by: Sequence[str | Column], checkpoint: str, name: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the latest row of each key as state below ``checkpoint``.

    The changes of a micro-batch go nowhere else. To hand them on, start
    ``latest_of_stream`` with a sink of your own.
    """
    writer = latest_of_stream(rows, key, order_by).writeStream.outputMode("update").format("noop")
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_latest(spark: SparkSession, checkpoint: str, key: str, batch_id: int | None = None) -> DataFrame:
    """The state as a table, after the last micro-batch or after ``batch_id``."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select(f"key.{key}", f"value.{KEPT}.*")
