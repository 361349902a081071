import json
import logging
import os
import pickle
import re

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from helpers import as_set, column
from tillwatch import schemas as S
from tillwatch.operators import cleaning, ml, rollups, serving
from tillwatch.operators.validation import has_required
from tillwatch.plans import flows
from tillwatch.plans.panels import panels
from tillwatch.sources import artifacts, tables, topics
from tillwatch.streaming import app, handlers, queries as Q
from tillwatch.streaming.config import StreamConfig
from tillwatch.streaming.latency import LatencyListener, read_latency
from tillwatch.streaming.stores import numbered_directories

READERS = {
    S.USER_TOPIC: tables.raw_users,
    S.MERCHANT_TOPIC: tables.raw_merchants,
    S.CARD_TOPIC: tables.raw_cards,
    S.TXN_TOPIC: tables.raw_event_txns,
}


@pytest.fixture(scope="module")
def inputs(spark, small, tmp_path_factory):
    """The four topics as JSON files, transactions in three files with some malformed lines."""
    root = tmp_path_factory.mktemp("topics")
    for topic, reader in READERS.items():
        rows = reader(spark, small)
        columns = [c for c in S.TOPIC_SCHEMAS[topic].fieldNames() if c in rows.columns]
        lines = [r["value"] for r in topics.encode(rows.select(*columns), columns[0]).collect()]
        if topic == S.TXN_TOPIC:
            lines += ["not json", "[1]"]
        parts = 3 if topic == S.TXN_TOPIC else 1
        (root / topic).mkdir()
        for i in range(parts):
            (root / topic / f"{i}.json").write_text("\n".join(lines[i::parts]) + "\n")
    return root


def config(inputs, root, **changes):
    where = {topic: str(inputs / topic) for topic in READERS}
    settings = dict(source="files", available_now=True, threshold=flows.RULE_THRESHOLD, **changes)
    return StreamConfig(str(root), where, **settings)


RULES = dict(scorer=flows.score_by_rules, columns=flows.RULE_COLUMNS)


def run_entities(spark, cfg):
    Q.wait({t: Q.start_upserts(spark, cfg, t) for t in (S.USER_TOPIC, S.MERCHANT_TOPIC, S.CARD_TOPIC)})


def run_txns(spark, cfg):
    Q.wait({S.TXN_TOPIC: Q.start_transactions(spark, cfg, **RULES)})


@pytest.fixture(scope="module")
def finished(spark, inputs, tmp_path_factory):
    """All entities first, then the transactions, one file per micro-batch."""
    cfg = config(inputs, tmp_path_factory.mktemp("app"), reader_options={"maxFilesPerTrigger": "1"})
    run_entities(spark, cfg)
    run_txns(spark, cfg)
    return cfg


def batch_scored(spark, inputs):
    """The same files read as one batch."""
    read = lambda t: topics.read_topic(spark, t, source="files", location=str(inputs / t), streaming=False)
    raw = read(S.TXN_TOPIC).filter(has_required(S.TXN_TOPIC))
    served = [
        flows.latest_entities(serve(clean(read(t))), key)
        for t, clean, serve, key in (
            (S.CARD_TOPIC, cleaning.clean_cards, serving.serve_cards, "card_ref"),
            (S.USER_TOPIC, cleaning.clean_users, serving.serve_users, "party_id"),
            (S.MERCHANT_TOPIC, cleaning.clean_merchants, serving.serve_merchants, "merchant_id"),
        )
    ]
    return flows.score_transactions(cleaning.clean_transactions(raw), *served)


def test_stream_equals_batch(spark, inputs, finished):
    scored = batch_scored(spark, inputs).cache()
    assert len(numbered_directories(spark, finished.counters.path, "batch_id")) == 3
    columns = ["txn_id", "amount_minor", "category", "channel", "ts"]
    assert as_set(finished.alerts.read(spark).select(*columns)) == as_set(rollups.alerts(scored).select(*columns))
    totals = handlers.daily_counters(finished.counters.read(spark))
    assert as_set(totals) == as_set(handlers.batch_counters(scored))
    points = finished.points.read(spark).groupBy("series").agg(F.sum("value").alias("value"))
    expected = rollups.batch_points(scored, F.current_timestamp()).select("series", "value").unionByName(
        rollups.histogram_points(rollups.score_histogram(scored), F.current_timestamp()).select("series", "value"))
    assert as_set(points) == as_set(expected)
    scored.unpersist()


def test_malformed_rows_are_set_aside(spark, finished):
    rejects = finished.rejects.read(spark)
    assert rejects.filter("event_id IS NULL").count() == 2
    kept = {r["value"]: r["missing"] for r in rejects.collect()}
    assert kept["not json"] == kept["[1]"] == S.REQUIRED_FIELDS[S.TXN_TOPIC]
    for value, missing in kept.items():
        if value.startswith("{"):
            assert missing == [f for f in S.REQUIRED_FIELDS[S.TXN_TOPIC] if json.loads(value).get(f) is None] != []


def test_latest_register_is_from_the_last_batch(spark, finished):
    value = column(handlers.latest_register(finished.latest.read(spark)), "latest_transaction_amount")
    assert len(value) == 1 and value[0] >= 0


def test_a_replayed_batch_changes_nothing(spark, inputs, finished):
    before = as_set(finished.alerts.read(spark)), as_set(handlers.daily_counters(finished.counters.read(spark)))
    raw = handlers.tag_before_cleaning(topics.decode(topics.read_messages(
        spark, S.TXN_TOPIC, source="files", location=str(inputs / S.TXN_TOPIC / "0.json"), streaming=False), S.TXN_SCHEMA,
        raw=True))
    clean = cleaning.clean_transactions(raw)
    txn_file = {tuple(r) for r in clean.filter("is_valid").select("event_id").collect()}
    batch_id = next(
        b for b in numbered_directories(spark, finished.alerts.path, "batch_id")
        if {(i,) for i in column(finished.alerts.read(spark).filter(F.col("batch_id") == b), "txn_id")} <= txn_file
    )
    handler = handlers.transaction_handler(finished, **RULES)
    handler(clean, batch_id)
    handler(clean, batch_id)
    after = as_set(finished.alerts.read(spark)), as_set(handlers.daily_counters(finished.counters.read(spark)))
    assert after == before


def test_restart_resumes_from_the_checkpoint(spark, inputs, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    files = sorted((inputs / S.TXN_TOPIC).iterdir())
    cfg = config(inputs, tmp_path / "app")
    cfg.locations[S.TXN_TOPIC] = str(source)
    run_entities(spark, cfg)
    counts = []
    for path in files:
        (source / path.name).write_text(path.read_text())
        run_txns(spark, cfg)
        points = cfg.points.read(spark).filter(F.col("series") == S.SERIES_COUNT)
        counts.append(points.agg(F.sum("value").alias("n")).first()["n"])
    run_txns(spark, cfg)
    alerts = cfg.alerts.read(spark)
    assert counts == sorted(set(counts))
    assert alerts.count() == alerts.select("txn_id").distinct().count()
    assert cfg.points.read(spark).filter(F.col("series") == S.SERIES_COUNT).agg(F.sum("value")).first()[0] == counts[-1]


def test_transactions_before_their_cards_are_not_flagged(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path)
    run_txns(spark, cfg)
    assert cfg.alerts.read(spark).count() == 0
    points = {r["series"]: r["value"] for r in cfg.points.read(spark).collect()}
    assert points[S.SERIES_COUNT] > 0 and points[S.SERIES_PREDICTED] == 0


def test_malformed_rows_count_if_asked(spark, inputs, tmp_path, finished):
    cfg = config(inputs, tmp_path, count_malformed=True)
    run_txns(spark, cfg)
    total = lambda c: c.points.read(spark).filter(F.col("series") == S.SERIES_COUNT).agg(F.sum("value")).first()[0]
    assert total(cfg) == total(finished) + finished.rejects.read(spark).count()


def test_metric_failure_does_not_fail_the_batch(spark, inputs, tmp_path, monkeypatch, caplog):
    cfg = config(inputs, tmp_path)
    run_entities(spark, cfg)

    def broken(*args):
        raise RuntimeError("no series today")

    monkeypatch.setattr(rollups, "batch_points", broken)
    with caplog.at_level(logging.ERROR):
        run_txns(spark, cfg)
    assert cfg.alerts.read(spark).count() > 0 and cfg.points.read(spark).count() == 0
    assert "series points were not written" in caplog.text


def test_a_failing_query_stops_the_others(spark, inputs, tmp_path):
    cfg = StreamConfig(str(tmp_path), {t: str(inputs / t) for t in READERS}, source="files", trigger_seconds=1)

    def broken(df):
        raise RuntimeError("scorer failed")

    started = Q.start_all(spark, cfg, scorer=broken)
    with pytest.raises(Exception, match="scorer failed"):
        Q.wait(started)
    assert set(started) == set(READERS)
    assert not any(q.isActive for q in started.values())


def test_four_queries_and_archives_run_together(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path)
    listener = LatencyListener(spark, cfg.latency_path)
    spark.streams.addListener(listener)
    try:
        started = Q.start_all(spark, cfg, archive=True, **RULES)
        Q.wait(started)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    listener.flush()
    assert set(started) == {*READERS, "archive"}
    archived = spark.read.parquet(cfg.archive_path)
    lines = {t: sum(len(p.read_text().splitlines()) for p in (inputs / t).iterdir()) for t in READERS}
    assert {r["topic"]: r["count"] for r in archived.groupBy("topic").count().collect()} == lines
    assert {"topic", "day"} <= set(archived.columns)
    latency = read_latency(spark, cfg.latency_path)
    assert set(column(latency, "series")) == set(S.LATENCY_SERIES.values())
    assert latency.filter("value < 0").count() == 0


def test_entity_store_keeps_the_last_version_through_compaction(spark, inputs, tmp_path):
    store = config(inputs, tmp_path).cards

    def put(batch_id, *rows):
        clean = cleaning.clean_cards(
            spark.createDataFrame([(c, p, f"e{batch_id}") for c, p in rows], "card_ref string, brand string, event_id string")
            .select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.CARD_SCHEMA
                           if f.name not in ("card_ref", "brand", "event_id")],
                    F.lit(None).cast("int").alias("kafka_partition"), F.lit(None).cast("bigint").alias("kafka_offset")))
        store.upsert(serving.serve_cards(clean), batch_id)

    view = lambda **k: as_set(store.latest(spark, **k).select("card_ref", "brand"))
    assert view() == []
    put(0, ("a", "one"), ("b", "one"), ("", "blank"), (None, "none"))
    put(1, ("a", "two"))
    assert view() == [("a", "TWO"), ("b", "ONE")]
    assert store.compact(spark) == 1 and store.compact(spark) is None
    put(2, ("b", "three"), ("c", "three"))
    expected = [("a", "TWO"), ("b", "THREE"), ("c", "THREE")]
    assert view() == expected
    put(2, ("b", "three"), ("c", "three"))
    assert view() == expected
    assert store.compact(spark) == 2
    assert view() == expected
    assert numbered_directories(spark, store.log.path, "batch_id") == [2]
    keys = spark.createDataFrame([("b",), ("zz",)], "card_ref string")
    assert view(keys=keys) == [("b", "THREE")]


def test_publish_writes_keyed_json(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path)
    raw = Q.records(spark, cfg, S.CARD_TOPIC).select("event_id", "card_ref", "brand")
    Q.wait({"out": Q.publish(raw, cfg, "out", "card_ref", str(tmp_path / "published"))})
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "published")).collect()]
    assert len(lines) == spark.read.text(str(inputs / S.CARD_TOPIC)).count()
    assert all("event_id" in line for line in lines)
    batch = topics.read_topic(spark, S.CARD_TOPIC, source="files", location=str(inputs / S.CARD_TOPIC), streaming=False)
    encoded = topics.encode(batch.select("card_ref", "brand"), "card_ref")
    assert encoded.columns == ["key", "value"]
    spread = topics.by_key(batch, "card_ref", 4).select("card_ref", F.spark_partition_id().alias("p")).distinct()
    assert spread.count() == batch.select("card_ref").distinct().count()


def test_kafka_reader_options():
    options = topics.kafka_options("host:9092", "card_account", maxOffsetsPerTrigger="1000")
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "card_account", "startingOffsets": "latest",
                       "maxOffsetsPerTrigger": "1000"}


def write_txns(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    # The file source takes files by age; files written at once need distinct ages.
    stamp = 1_700_000_000 + int(name.split(".")[0])
    os.utime(path / name, (stamp, stamp))


def test_watermark_windows_and_duplicates(spark, tmp_path):
    source = tmp_path / "txns"
    row = lambda i, second: {"event_id": str(i), "event_epoch_sec": 1700000000 + second, "amount_minor": 100,
                             "card_ref": "c", "merchant_ref": "m"}
    write_txns(source, "0.json", [row(1, 0), row(2, 3), row(1, 0)])
    write_txns(source, "1.json", [row(3, 4), row(4, 60)])
    write_txns(source, "2.json", [row(7, 61)])
    write_txns(source, "3.json", [row(5, 1), row(6, 90), row(2, 3)])
    cfg = StreamConfig(str(tmp_path / "app"), {S.TXN_TOPIC: str(source)}, source="files", available_now=True,
                       reader_options={"maxFilesPerTrigger": "1"})
    clean = cleaning.clean_transactions(Q.records(spark, cfg, S.TXN_TOPIC))

    seen = Q.deduplicated(clean, "1 hour").select("event_id")
    Q.wait({"dedup": Q._writer(seen, cfg, "dedup").format("memory").start()})
    assert sorted(column(spark.table("dedup"), "event_id")) == ["1", "2", "3", "4", "5", "6", "7"]

    totals = Q.windowed_totals(clean, "10 seconds").selectExpr("unix_seconds(bucket_start) - 1700000000 AS s", "n")
    Q.wait({"totals": Q._writer(totals, cfg, "totals").format("memory").start()})
    got = {r["s"]: r["n"] for r in spark.table("totals").collect()}
    # Row 3 is late but in time for its window; row 5 and the repeat of 2 come after it has closed.
    # Rows are dropped by the watermark of the batch before, hence the batch in between.
    assert got == {0: 4, 60: 2}


def test_no_row_is_lost_while_repeats_are_dropped(spark, tmp_path):
    source = tmp_path / "txns"
    row = lambda i, second, **more: {"event_id": str(i), "event_epoch_sec": 1700000000 + second, "amount_minor": 100,
                                     "card_ref": "c", "merchant_ref": "m", **more}
    write_txns(source, "0.json", [row(1, 0), row(2, 7200), row(1, 0), {"event_id": "x"}])
    (source / "0.json").open("a").write("not json\n[1]\n{}\n")
    os.utime(source / "0.json", (1_700_000_000, 1_700_000_000))
    write_txns(source, "1.json", [row(3, 9000), row(2, 7200), row(4, 10, auth_code="late"), row(0, 5, event_id=None)])
    write_txns(source, "2.json", [row(1, 0), row(5, 9001), row(3, 9000), row(5, 9001)])
    cfg = StreamConfig(str(tmp_path / "app"), {S.TXN_TOPIC: str(source)}, source="files", available_now=True,
                       deduplicate_within="1 hour", reader_options={"maxFilesPerTrigger": "1"})
    run_txns(spark, cfg)
    points = cfg.points.read(spark).filter(F.col("series") == S.SERIES_COUNT)
    assert points.agg(F.sum("value")).first()[0] == 5  # 1, 2, 3, 5 and the late 4
    assert sorted(column(cfg.seen.read(spark), "event_id")) == ["1", "2", "3", "4", "5"]
    rejects = cfg.rejects.read(spark)
    assert rejects.count() == 5 and rejects.filter("value = 'not json'").count() == 1
    handlers.compact(spark, cfg)
    assert sorted(column(cfg.seen.read(spark), "event_id")) == ["2", "3", "5"]
    write_txns(source, "3.json", [row(5, 9001), row(6, 9002)])
    run_txns(spark, cfg)
    assert cfg.points.read(spark).filter(F.col("series") == S.SERIES_COUNT).orderBy(F.desc("batch_id")).first()["value"] == 1


def test_stores_are_compacted_trimmed_and_expired(spark, inputs, tmp_path, monkeypatch):
    cfg = config(inputs, tmp_path, reader_options={"maxFilesPerTrigger": "1"})
    run_entities(spark, cfg)
    run_txns(spark, cfg)
    totals = as_set(handlers.daily_counters(cfg.counters.read(spark)))
    latest = as_set(handlers.latest_register(cfg.latest.read(spark)))
    newest = as_set(rollups.recent_alerts(cfg.alerts.read(spark), 3).drop("batch_id"))
    monkeypatch.setattr(rollups.recent_alerts, "__defaults__", (3,))
    handlers.compact(spark, cfg)
    handlers.compact(spark, cfg)  # nothing new: nothing happens
    assert as_set(handlers.daily_counters(cfg.counters.read(spark))) == totals
    assert as_set(handlers.latest_register(cfg.latest.read(spark))) == latest and cfg.latest.read(spark).count() == 1
    assert as_set(cfg.alerts.read(spark).drop("batch_id")) == newest
    old = spark.createDataFrame([("s", None, 1)], "series string, ts timestamp, value bigint").withColumn(
        "ts", F.expr("current_timestamp() - interval 1 day"))
    cfg.points.write(old.unionByName(old.withColumn("ts", F.current_timestamp())), 10)
    handlers.compact(spark, cfg)
    assert cfg.points.read(spark).filter("series = 's'").count() == 1
    assert numbered_directories(spark, cfg.points.path, "batch_id") == [10]  # the ones before the last snapshot are gone


def test_a_batch_opens_its_own_buckets(spark, inputs, tmp_path):
    store = config(inputs, tmp_path).cards
    rows = spark.range(1000).select(F.col("id").cast("string").alias("card_ref"), F.lit("b").alias("brand"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in store.schema if f.name not in ("card_ref", "brand")])
    store.upsert(rows, 0)
    store.compact(spark)
    found = store.latest(spark, spark.createDataFrame([("5",), ("77",)], "card_ref string"), ["brand"])
    assert sorted(column(found, "card_ref")) == ["5", "77"]
    scans = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket#\d+ (IN|=)", scans)


def test_times_of_any_form_are_ordered(spark):
    forms = [("a", "2024-01-01T10:00:00Z", 1), ("b", "2024-01-01T16:30:00+07:00", 2),
             ("c", "2024-01-01T10:00:00.5Z", 3), ("d", "2024-01-01T09:59:59.999999+00:00", 4), ("e", "never", 5)]
    feed = spark.createDataFrame(forms, "txn_id string, ts string, amount_minor long")
    assert column(rollups.recent_alerts(feed), "txn_id") == ["c", "a", "d", "b", "e"]
    versions = spark.createDataFrame([("k", ts, i) for i, ts, _ in forms], "party_id string, event_ts string, event_id string")
    assert column(flows.latest_entities(versions, "party_id"), "event_id") == ["c"]


def test_running_daily_counts_agree_with_the_batch(spark, tmp_path, inputs):
    cfg = config(inputs, tmp_path)
    txns = cleaning.clean_transactions(Q.records(spark, cfg, S.TXN_TOPIC))
    flagged = txns.withColumn("predicted_fraud", (F.col("amount_minor") > 5000).cast("int"))
    running = Q.running_daily_counts(flagged, "40 days", "channel_code")
    Q.wait({"daily": Q._writer(running, cfg, "daily", "complete").format("memory").start()})
    batch = topics.read_topic(spark, S.TXN_TOPIC, source="files", location=str(inputs / S.TXN_TOPIC), streaming=False)
    expected = cleaning.clean_transactions(batch).filter("amount_minor > 5000").groupBy(
        F.date_format("trans_date_trans_time", "yyyyMMdd").alias("day"), "channel_code").count()
    assert as_set(spark.table("daily")) == as_set(expected)


def test_application_runs_from_its_arguments(spark, inputs, tmp_path):
    argv = ["--root", str(tmp_path), "--files", str(inputs), "--available-now", "--archive", "--max-per-trigger", "2",
            "--threshold", "0.4"]
    app.main(argv)
    cfg = app.stream_config(app.arguments(argv))
    app.main([*argv, "--compact"])
    assert numbered_directories(spark, f"{cfg.cards.path}/snapshot", "upto") == [0]

    # Entities and transactions raced; scoring the archive again settles it.
    scored = app.rescore_archive(spark, cfg, lambda df: flows.score_by_formulas(df, cfg.threshold), flows.FORMULA_COLUMNS)
    flagged = {r["event_id"] for r in scored.filter("predicted_fraud = 1").select("event_id").collect()}
    assert flagged and set(column(cfg.alerts.read(spark), "txn_id")) <= flagged
    assert app.rescore_archive(spark, cfg, flows.score_by_rules, flows.RULE_COLUMNS,
                               days=F.col("day") < "2000-01-01").count() == 0

    shown = panels(cfg.points.read(spark), read_latency(spark, cfg.latency_path))
    assert len(shown) == 10
    assert sum(column(shown["throughput"], "value")) == 1000 - rejected(spark, cfg)
    assert shown["fraud_gauge"].count() == 1 and shown["latency_card_txn_auth"].count() >= 1


def rejected(spark, cfg):
    return cfg.rejects.read(spark).filter("event_id IS NOT NULL").count()


def test_stream_scores_with_a_saved_ensemble(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path)
    run_entities(spark, cfg)
    training = flows.with_model_features(batch_enriched(spark, cfg, inputs)).withColumn(
        "label", (F.col("risk_score_online") > 0.3).cast("int"))
    fitted = ml.fit_ensemble(training, "label", ["amt", "risk_score_online", "hour"], ["category"], trees=2, depth=2)
    fitted.save(str(tmp_path / "model"))
    ensemble = ml.load_ensemble(spark, str(tmp_path / "model"))
    Q.wait({S.TXN_TOPIC: Q.start_transactions(spark, cfg, lambda df: flows.score_by_ensemble(df, ensemble), None)})
    assert cfg.alerts.read(spark).count() > 0


def batch_enriched(spark, cfg, inputs):
    raw = topics.read_topic(spark, S.TXN_TOPIC, source="files", location=str(inputs / S.TXN_TOPIC), streaming=False)
    return handlers.score_batch(cleaning.clean_transactions(raw), cfg, lambda df: df, None)


def test_stream_scores_with_opaque_models_as_the_batch_does(spark, inputs, tmp_path):
    from tillwatch.plans import queries as plans

    cfg = config(inputs, tmp_path)
    run_entities(spark, cfg)
    names = ["amt", "risk_score_online", "risk_score_merchant", "absent"]
    artifact = tmp_path / "models.bin"
    artifact.write_bytes(cloudpickle.dumps((plans.FLOW_MODELS, names, lambda frame: frame.fillna(0.0))))
    loaded = pickle.loads(artifacts.read_artifact(spark, str(artifact)))
    scorer = flows.opaque_scorer(spark, *loaded, threshold=0.3)
    Q.wait({S.TXN_TOPIC: Q.start_transactions(spark, cfg, scorer, None)})
    raw = topics.read_topic(spark, S.TXN_TOPIC, source="files", location=str(inputs / S.TXN_TOPIC), streaming=False)
    clean = cleaning.clean_transactions(raw.filter(has_required(S.TXN_TOPIC)))
    expected = handlers.score_batch(clean, cfg, scorer, None).filter("predicted_fraud = 1")
    got = column(cfg.alerts.read(spark), "txn_id")
    assert got and sorted(got) == sorted(column(expected, "event_id"))


def test_arguments_need_a_source():
    with pytest.raises(SystemExit):
        app.arguments(["--root", "x"])
    cfg = app.stream_config(app.arguments(["--root", "x", "--servers", "h:1", "--max-per-trigger", "5"]))
    assert cfg.source == "kafka" and set(cfg.locations.values()) == {"h:1"}
    assert cfg.reader_options == {"maxOffsetsPerTrigger": "5"}


def test_nothing_stays_cached_after_ten_batches(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path / "app", deduplicate_within="1 day")
    run_entities(spark, cfg)
    raw = topics.decode(
        topics.read_messages(spark, S.TXN_TOPIC, source="files", location=str(inputs / S.TXN_TOPIC), streaming=False),
        S.TXN_SCHEMA, raw=True)
    clean = cleaning.clean_transactions(handlers.tag_before_cleaning(raw))
    spark.catalog.clearCache()
    handle = handlers.transaction_handler(cfg, **RULES)
    for batch_id in range(10):
        handle(clean.filter(F.abs(F.hash("value")) % 10 == batch_id), batch_id)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    assert len(numbered_directories(spark, cfg.points.path, "batch_id")) == 10
