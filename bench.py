"""Headline timings as one line of JSON, batch queries first, then the transaction stream.

``BENCH_SF_DIR`` names the data directory, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` optionally a comma-separated choice of queries. ``BENCH_ROOT`` is
the shared folder for the stream's input, stores and checkpoints, by default a
temporary one. Each query is planned and run in full (into the no-op sink), once
to warm up and then ``RUNS`` times; the best run counts, planning included, and
the slowest is in ``slowest``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwatch import build_session  # noqa: E402
from tillwatch import schemas as S  # noqa: E402
from tillwatch.plans.queries import QUERIES  # noqa: E402
from tillwatch.sources import tables, topics  # noqa: E402
from tillwatch.streaming import queries as streams  # noqa: E402
from tillwatch.streaming.config import StreamConfig  # noqa: E402

HEADLINE = [
    "clean_txn",
    "clean_user",
    "json_decode",
    "dq_profile",
    "latest_by_key_cards",
    "enrich_txn",
    "asof_enrich",
    "orphan_audit",
    "rule_score",
    "ensemble_score",
    "opaque_ensemble_score",
    "fraud_by_category_day",
    "fraud_by_channel_day",
    "batch_metrics",
    "score_histogram",
    "recent_alerts",
    "rollup_sum_5s_amount",
    "rollup_max_5s",
    "retention_10m",
    "series_reducers",
]
RUNS = 3
MICRO_BATCHES = 4


def stream_seconds(spark, directory: str, folder: str) -> tuple[float, int]:
    """Seconds to drain the event stream through the transaction query, and its length.

    The entity queries run first and are not counted; neither is writing the input.
    """
    readers = {
        S.USER_TOPIC: tables.raw_users, S.MERCHANT_TOPIC: tables.raw_merchants,
        S.CARD_TOPIC: tables.raw_cards, S.TXN_TOPIC: tables.raw_event_txns,
    }
    for topic, reader in readers.items():
        rows = reader(spark, directory)
        fields = [name for name in S.TOPIC_SCHEMAS[topic].fieldNames() if name in rows.columns]
        files = 2 * MICRO_BATCHES
        topics.encode(rows.select(*fields), S.TOPIC_KEYS[topic]).select("value").repartition(files).write.text(
            f"{folder}/in/{topic}")
    config = StreamConfig(f"{folder}/app", {t: f"{folder}/in/{t}" for t in readers}, source="files", available_now=True,
                          reader_options={"maxFilesPerTrigger": "2"})
    entities = (S.USER_TOPIC, S.MERCHANT_TOPIC, S.CARD_TOPIC)
    streams.wait({topic: streams.start_upserts(spark, config, topic) for topic in entities}, poll_seconds=0.1)
    started = time.perf_counter()
    streams.wait({S.TXN_TOPIC: streams.start_transactions(spark, config)}, poll_seconds=0.1)
    seconds = time.perf_counter() - started
    return seconds, spark.read.text(f"{folder}/in/{S.TXN_TOPIC}").count()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    timings, slowest = {}, {}
    for name in chosen.split(",") if chosen else HEADLINE:
        runs = []
        for _ in range(1 + RUNS):
            started = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        timings[name], slowest[name] = round(min(runs[1:]), 3), round(max(runs[1:]), 3)
    extra = {"slowest": slowest}
    if not chosen:
        seconds, length = stream_seconds(spark, directory, tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_ROOT")))
        timings["stream_card_txn_auth"] = round(seconds, 3)
        extra["stream_txn_per_sec"] = round(length / seconds)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        **extra,
        "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
