"""Micro-batch durations as series points."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from tillwatch import schemas as S
from tillwatch.streaming.config import LATENCIES

log = logging.getLogger(__name__)


class LatencyListener(StreamingQueryListener):
    """Collects ``triggerExecution`` milliseconds per query; ``flush`` appends them to Parquet.

    A point is a few bytes per trigger, and the buffer is written out once it
    holds ``flush_every`` of them.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 100):
        self.spark, self.path, self.flush_every = spark, path, flush_every
        self.buffer: list[tuple[str, datetime, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        millis = progress.durationMs.get("triggerExecution")
        if millis is None or progress.name not in S.LATENCY_SERIES:
            return
        stamp = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        self.buffer.append((S.LATENCY_SERIES[progress.name], stamp, int(millis)))
        if len(self.buffer) >= self.flush_every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.buffer = self.buffer, []
        if not rows:
            return
        try:
            self.spark.createDataFrame(rows, LATENCIES).coalesce(1).write.mode("append").parquet(self.path)
        except Exception:
            log.exception("latency points were not written")


def read_latency(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LATENCIES).parquet(path)
