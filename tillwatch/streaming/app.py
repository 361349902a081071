"""The application: four streaming queries, their latency series and optional archive.

    spark-submit --packages <kafka connector> -m tillwatch.streaming.app \
        --servers host:9092 --root s3a://bucket/risk --model s3a://bucket/model

Hosts, paths and credentials come from arguments and from the cluster's Spark
configuration; none are kept in the code.
"""

from __future__ import annotations

import argparse
import pickle
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwatch import schemas as S
from tillwatch.operators import cleaning
from tillwatch.operators.latest import instant, latest_by_key
from tillwatch.operators.ml import load_ensemble
from tillwatch.operators.validation import has_required
from tillwatch.plans import flows
from tillwatch.session import build_session
from tillwatch.sources import topics
from tillwatch.sources.artifacts import read_artifact
from tillwatch.streaming import handlers, queries
from tillwatch.streaming.config import StreamConfig
from tillwatch.streaming.latency import LatencyListener


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="shared folder for stores and checkpoints")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--files", help="instead of Kafka: a directory with one folder of JSON lines per topic")
    parser.add_argument("--run", default="r1", help="name of this generation of checkpoints")
    parser.add_argument("--model", help="saved ensemble; without it the fixed formulas score")
    parser.add_argument(
        "--opaque-model", help="pickled (models, feature names, preprocess or None); a file of your own, as it runs code")
    parser.add_argument("--threshold", type=float, default=S.FRAUD_THRESHOLD)
    parser.add_argument("--trigger-seconds", type=int)
    parser.add_argument("--max-per-trigger", type=int, help="offsets or files per micro-batch")
    parser.add_argument("--deduplicate-within", help="drop event ids seen within this span, such as '10 minutes'")
    parser.add_argument("--count-malformed", action="store_true", help="score and count rows that lack required fields")
    parser.add_argument("--hour-from-event-time", action="store_true", help="derive hours instead of trusting the field")
    parser.add_argument("--available-now", action="store_true", help="process what is there and stop")
    parser.add_argument("--archive", action="store_true", help="also keep the raw messages")
    parser.add_argument("--compact", action="store_true", help="compact all stores, expire and trim them, and exit")
    parsed = parser.parse_args(argv)
    if not (parsed.servers or parsed.files):
        parser.error("one of --servers and --files is required")
    return parsed


def stream_config(options: argparse.Namespace) -> StreamConfig:
    source = "files" if options.files else "kafka"
    limit = "maxFilesPerTrigger" if options.files else "maxOffsetsPerTrigger"
    return StreamConfig(
        root=options.root,
        run=options.run,
        source=source,
        locations={t: f"{options.files}/{t}" if options.files else options.servers for t in S.TOPIC_SCHEMAS},
        threshold=options.threshold,
        available_now=options.available_now,
        trigger_seconds=options.trigger_seconds,
        deduplicate_within=options.deduplicate_within,
        count_malformed=options.count_malformed,
        hour_from_event_time=options.hour_from_event_time,
        reader_options={limit: str(options.max_per_trigger)} if options.max_per_trigger else {},
    )


def rescore_archive(
    spark: SparkSession,
    config: StreamConfig,
    scorer: flows.Scorer,
    columns: dict[str, list[str]] | None = None,
    days: Column | None = None,
) -> DataFrame:
    """Score archived transactions again with the entities known by now.

    Finds what the stream could not: transactions that came before their card.
    ``days`` is a condition on the archive's ``day`` and prunes its partitions.
    """
    archived = spark.read.parquet(config.archive_path).filter(F.col("topic") == S.TXN_TOPIC)
    if days is not None:
        archived = archived.filter(days)
    raw = topics.decode(archived, S.TXN_SCHEMA).filter(has_required(S.TXN_TOPIC))
    # Of repeats the last to arrive counts.
    once = latest_by_key(raw, "event_id", [instant("event_ts"), "kafka_partition", "kafka_offset", "amount_minor"])
    clean = cleaning.clean_transactions(once, config.hour_from_event_time)
    return handlers.score_batch(clean, config, scorer, columns)


def main(argv: Sequence[str] | None = None) -> None:
    options = arguments(argv)
    spark = build_session("tillwatch")
    config = stream_config(options)
    if options.compact:
        handlers.compact(spark, config)
        return
    scorer, columns = None, flows.FORMULA_COLUMNS
    if options.model:
        ensemble = load_ensemble(spark, options.model)
        scorer, columns = (lambda df: flows.score_by_ensemble(df, ensemble, config.threshold)), None
    elif options.opaque_model:
        models, names, preprocess = pickle.loads(read_artifact(spark, options.opaque_model))
        scorer, columns = flows.opaque_scorer(spark, models, names, preprocess, config.threshold), None
    listener = LatencyListener(spark, config.latency_path)
    spark.streams.addListener(listener)
    try:
        queries.wait(queries.start_all(spark, config, scorer, columns, archive=options.archive))
    finally:
        spark.streams.removeListener(listener)
        listener.flush()
        if options.opaque_model:
            scorer.release()


if __name__ == "__main__":
    main()
