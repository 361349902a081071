"""State, corrections, bucketed joins, series, ranges, filters, offsets, cut-offs and variants on small rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import as_set
from tillwatch import schemas as S
from tillwatch.operators import bloom, corrections as C, cutoff, dyadic, offsets, variants
from tillwatch.operators.joins import asof_lookup
from tillwatch.sources import bucketed, workspace
from tillwatch.streaming import state
from tillwatch.streaming.series import SeriesStore

T0 = datetime(2024, 3, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------------ state
def test_state_keeps_the_latest_row_over_a_restart(spark, tmp_path):
    schema = "k string, t long, v string"
    session = state.state_session(spark, 3)

    def run(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = session.readStream.schema(schema).parquet(str(tmp_path / "in"))
        state.start_latest(stream, "k", ["t", "v"], str(tmp_path / "state")).awaitTermination()

    run(("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), (None, 9, "no key"))
    run(("a", 2, "late"), ("c", 1, None), ("b", 2, "zz"))
    read = lambda **at: as_set(state.read_latest(spark, str(tmp_path / "state"), "k", **at))
    assert read() == [("a", 3, "y"), ("b", 2, "zz"), ("c", 1, None)]
    assert read(batch_id=0) == [("a", 3, "y"), ("b", 2, "z")]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != session.conf.get(
        "spark.sql.streaming.stateStore.providerClass")


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Cluster)


# ------------------------------------------------------------------ corrections
@pytest.mark.parametrize("seed, rows_per_task", [(1, 1000), (2, 4)])
def test_corrections_bring_a_first_result_up_to_date(spark, seed, rows_per_task):
    rng = random.Random(seed)
    day = lambda: T0 + timedelta(days=rng.randrange(200), hours=rng.choice([0, 0, 5]))
    facts = spark.createDataFrame([(i, rng.choice(["a", "b", "c", None]), day()) for i in range(300)],
                                  "id long, k string, ts timestamp_ntz")
    versions = [(rng.choice(["a", "b", "d", None]), rng.choice([day(), day(), None]), f"v{i}") for i in range(40)]
    schema = "k string, at timestamp_ntz, name string"
    known, late = spark.createDataFrame(versions[:30], schema), spark.createDataFrame(versions[30:] + versions[:2], schema)
    look = lambda v: asof_lookup(facts, v, "k", "ts", "at", ["name"], rows_per_task=rows_per_task)
    changed = C.changed_intervals(known, late, "k", "at", ["name"])
    again = C.corrections(facts, changed, "k", "ts", rows_per_task=rows_per_task).withColumnRenamed(C.FROM, "at")
    first = look(known)
    merged = first.join(again.select("id"), "id", "left_anti").unionByName(again)
    columns = ["id", "k", "ts", "at", "name"]
    assert as_set(merged.select(*columns)) == as_set(look(known.unionByName(late)).select(*columns))
    differing = look(known.unionByName(late)).select(*columns).exceptAll(first.select(*columns)).count()
    assert differing == again.count() < 300 and (differing > 0 or seed == 1)


def test_corrections_read_changed_partitions_only(spark, tmp_path):
    rows = [(i, "a", T0 + timedelta(days=i)) for i in range(300)]
    facts = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz").withColumn(C.BUCKET, F.date_trunc("month", "ts"))
    facts.write.partitionBy(C.BUCKET).parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    schema = "k string, at timestamp_ntz, name string"
    known = spark.createDataFrame([("a", T0, "one"), ("a", T0 + timedelta(days=100), "two")], schema)
    late = spark.createDataFrame([("a", T0 + timedelta(days=70), "between"), ("a", T0, "a")], schema)
    changed = C.changed_intervals(known, late, "k", "at", ["name"])
    assert [tuple(r) for r in changed.collect()] == [("a", T0 + timedelta(days=70), "between", T0 + timedelta(days=100))]
    named = C.changed_partitions(changed, "k", "month", stored.agg(F.max("ts")))
    near = stored.filter(F.col(C.BUCKET).isin(named))
    assert len(named) == 2 and len(near.inputFiles()) == len(stored.inputFiles()) and "PartitionFilters: [_bucket" in plan_of(near)
    assert sorted(r.id for r in C.corrections(near, changed, "k", "ts").collect()) == list(range(70, 100))


@pytest.mark.parametrize("key_type, most_blocks", [("string", 1000), ("string", 0), ("int", 1000)])
def test_facts_to_look_up_again_are_told_by_a_filter(spark, monkeypatch, key_type, most_blocks):
    """Not by shuffling all facts, unless the places are too many for one or keys have to be brought to one type."""
    monkeypatch.setattr(bloom, "MOST_BLOCKS", most_blocks)
    facts = spark.createDataFrame([(i, str(i % 20) if i % 50 else None, T0 + timedelta(days=i) if i % 70 else None) for i in range(400)],
                                  "id long, k string, ts timestamp_ntz")
    changed = spark.createDataFrame([("3", T0 + timedelta(days=50), "x", T0 + timedelta(days=200)), ("8", T0 + timedelta(days=300), "y", None)],
                                    f"k string, {C.FROM} timestamp_ntz, name string, {C.TO} timestamp_ntz")
    again = C.corrections(facts, changed.withColumn("k", F.col("k").cast(key_type)), "k", "ts", skew_from=facts.select("k"))
    told = key_type == "string" and most_blocks > 0
    assert ("_maybe" in plan_of(again) or "_block" in plan_of(again)) == told and ("LeftSemi" in plan_of(again)) != told
    expected = [(i, "x" if i % 20 == 3 else "y") for i in range(400)
                if i % 50 and i % 70 and (i % 20 == 3 and 50 <= i < 200 or i % 20 == 8 and i >= 300)]
    assert sorted((r.id, r.name) for r in again.select("id", "name").collect()) == expected


# --------------------------------------------------------------------- buckets
def test_bucketed_entities_are_not_shuffled(spark):
    cards = spark.createDataFrame([(str(i), f"card {i}") for i in range(50)], "k string, name string")
    facts = spark.createDataFrame([(i, str(i % 70)) for i in range(500)] + [(-1, None)], "id long, k string")
    table = bucketed.write_bucketed(cards, "k", 4, "cards")
    joined = bucketed.join_bucketed(facts, spark, table, "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(joined)
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert "Exchange" not in plan[plan.index("FileScan") - 200:]  # the one exchange is on the side of the facts
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert as_set(joined) == as_set(facts.join(cards, "k", "left"))


# ---------------------------------------------------------------------- series
def test_series_are_read_by_their_hours_and_dropped_by_them(spark, tmp_path):
    store = SeriesStore(str(tmp_path / "series"))
    assert store.read(spark).count() == 0
    points = [(f"ts:{s}", T0 + timedelta(minutes=20 * i), i * (s + 1)) for s in range(2) for i in range(30)]
    df = spark.createDataFrame(points, "series string, ts timestamp_ntz, value long")
    early = F.col("ts") < T0 + timedelta(hours=4, minutes=30)
    for batch_id, part in ((0, early), (1, ~early), (1, ~early), (0, early)):
        store.write(df.filter(part), batch_id)
    assert as_set(store.read(spark)) == as_set(df)
    since, until = T0 + timedelta(hours=2, minutes=10), T0 + timedelta(hours=4)
    part = store.read(spark, "ts:1", since, until)
    assert as_set(part) == sorted((p for p in points if p[0] == "ts:1" and since <= p[1] <= until), key=repr)
    scan = part._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "PartitionFilters: [isnotnull(series" in plan_of(part)
    assert scan.metrics().apply("numFiles").value() == 4  # hour 4 is in both batches
    assert store.retain(spark, 3_600_000) == 2 * 8
    kept = store.read(spark)
    assert kept.agg(F.min("ts")).first()[0] == T0 + timedelta(hours=8) and kept.count() == 12


# ---------------------------------------------------------------------- dyadic
def test_ranges_from_nodes(spark):
    rng = random.Random(3)
    points = [(s, T0 + timedelta(seconds=rng.randrange(5000), milliseconds=rng.choice([0, 7])), rng.randrange(-50, 50))
              for s in ("x", "y") for _ in range(400)] + [("x", T0, None)]
    points = list({(s, t): (s, t, v) for s, t, v in points}.values())
    stored = dyadic.nodes(spark.createDataFrame(points, "series string, ts timestamp_ntz, value long"), 6)
    start = int((T0 - datetime(1970, 1, 1)).total_seconds())
    spans = [(i, rng.choice("xy"), *sorted(start + rng.randrange(-10, 5100) for _ in range(2))) for i in range(60)]
    spans += [(60, "x", start, start + 5000), (61, "y", start + 9, start + 9), (62, "y", start + 63, start + 64)]
    ranges = spark.createDataFrame(spans, "range_id long, series string, _from long, _to long")
    expected = []
    for i, series, a, b in spans:
        inside = [(t, v) for s, t, v in points
                  if s == series and v is not None and a <= int((t - datetime(1970, 1, 1)).total_seconds()) < b]
        if inside:
            values = [v for _, v in inside]
            expected.append((i, series, len(values), sum(values), max(values), max(inside)[1]))
    got = dyadic.over_ranges(stored, ranges, 6).select("range_id", "series", "n", "sum", "max", "last")
    assert as_set(got) == sorted(expected, key=repr)
    nodes = dyadic.covering(ranges, 6).filter("level < 6").groupBy("range_id", "level").count().agg(F.max("count")).first()[0]
    assert nodes <= 2


# ----------------------------------------------------------------- Bloom filter
def test_filter_spares_the_shuffle_and_loses_nothing(spark):
    keys = spark.createDataFrame([(str(i),) for i in range(0, 2000, 2)] + [(None,)], "k string")
    facts = spark.createDataFrame([(i, str(i)) for i in range(2000)] + [(-1, None)], "id long, ref string")
    marked = bloom.told(facts, keys.filter("k IS NOT NULL"), "ref", "k")
    maybe = marked.filter("_maybe").count()
    assert 1000 <= maybe < 1250  # all that are known, and few of the thousand others
    assert sorted(r.id for r in bloom.orphans(facts, keys, "ref", "k").collect()) == [-1, *range(1, 2000, 2)]
    assert bloom.orphans(facts, keys.limit(0), "ref", "k").count() == 2001


def test_too_many_keys_are_joined_at_once(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BLOCKS", 1)
    keys = spark.createDataFrame([(str(i),) for i in range(20)], "k string")
    facts = spark.createDataFrame([(1, "5"), (2, "50"), (3, None)], "id long, ref string")
    assert sorted(r.id for r in bloom.orphans(facts, keys, "ref", "k").collect()) == [2, 3]


def test_more_keys_fill_the_blocks_before_they_are_joined(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BLOCKS", 100)
    keys = spark.range(0, 1600, 2).selectExpr("cast(id AS string) AS k")
    facts = spark.range(1600).selectExpr("id", "cast(id AS string) AS ref")
    marked = bloom.told(facts, keys, "ref", "k")
    assert 800 <= marked.filter("_maybe").count() < 900
    assert sorted(r.id for r in bloom.orphans(facts, keys, "ref", "k").collect()) == list(range(1, 1600, 2))
    assert bloom.told(facts, spark.range(1601).selectExpr("cast(id AS string) AS k"), "ref", "k") is None


# --------------------------------------------------------------------- offsets
def plain_faults(rows, ends=()):
    seen = defaultdict(lambda: defaultdict(int))
    for p, o in ends:
        seen[p][o] += 1
    for p, o in rows:
        if p is not None and o is not None and o > dict(ends).get(p, -1):
            seen[p][o] += 1
    out = []
    for p, counts in seen.items():
        offs = sorted(counts)
        out += [(p, "missing", a + 1, b - 1) for a, b in zip(offs, offs[1:]) if b > a + 1]
        run = []
        for o in [*[o for o in offs if counts[o] > 1], None]:
            if run and (o is None or o != run[-1] + 1):
                out.append((p, "repeated", run[0], run[-1]))
                run = []
            run.append(o)
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [4, 16, 1000])
def test_offset_faults_over_batches(spark, block):
    rng = random.Random(block)
    batches = [[(p, o) for p in (0, 0, 0, 1) for o in range(base, base + 80) if rng.random() > 0.4] for base in (0, 75)]
    batches[1] += [(2, 5), (2, 9), (None, 1), (0, None)]
    ends, df_ends = (), None
    for rows in batches:
        df = spark.createDataFrame(rows, "kafka_partition int, kafka_offset long")
        got = offsets.faults(df, df_ends, block).select("kafka_partition", "fault", "first_offset", "last_offset")
        assert set(as_set(got)) ^ set(plain_faults(rows, ends)) == set() and got.count() == len(plain_faults(rows, ends))
        df_ends = offsets.ends(df, df_ends)
        ends = tuple(sorted(map(tuple, df_ends.collect())))
    assert dict(ends)[2] == 9


# -------------------------------------------------------------------- cut-offs
def test_area_cutoff_and_calibration_against_plain_counting(spark):
    rng = random.Random(6)
    rows = [(rng.choice([round(rng.random(), 2), 0.25]), 0) for _ in range(400)]
    rows = [(s, int(rng.random() < s)) for s, _ in rows]
    df = spark.createDataFrame(rows + [(None, 1), (0.5, None)], "score double, label int")
    pos, neg = [s for s, x in rows if x], [s for s, x in rows if not x]
    area = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    gains = {c: (sum(p >= c for p in pos) * len(neg) - sum(n >= c for n in neg) * len(pos), c) for c in {s for s, _ in rows}}
    got = cutoff.auc_and_cutoff(df, "score", "label", 16).first()
    best = max(gains, key=gains.get)
    assert got.auc == pytest.approx(area) and got.cutoff == best
    assert (got.true_positives, got.false_positives) == (sum(p >= best for p in pos), sum(n >= best for n in neg))

    groups = defaultdict(lambda: [0, 0])
    for s, x in rows:
        groups[s][0] += x
        groups[s][1] += 1
    blocks = []
    for s in sorted(groups):
        blocks.append([s, s, *groups[s]])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            low, high = blocks[-2], blocks.pop()
            low[1], low[2], low[3] = high[1], low[2] + high[2], low[3] + high[3]
    fitted = [tuple(r) for r in cutoff.isotonic(df, "score", "label").orderBy("low").collect()]
    assert fitted == [(a, b, pytest.approx(p / n), n) for a, b, p, n in blocks]


def test_one_class_has_no_area(spark):
    got = cutoff.auc_and_cutoff(spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int"), "score", "label").first()
    assert tuple(got) == (None, None, None, None)


# -------------------------------------------------------------------- variants
def test_fields_that_nobody_declared(spark):
    lines = ['{"event_id":"1","amount_minor":5,"more":{"a":1}}', '{"event_id":2,"amount_minor":"5","list":[1],"more":null}',
             "not json", "[1]", "", None, "{}", '{"event_id":true}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n int, value string")
    assert as_set(variants.field_types(df, "value")) == sorted(
        [("event_id", "string", 1), ("event_id", "number", 1), ("event_id", "boolean", 1), ("amount_minor", "number", 1),
         ("amount_minor", "string", 1), ("more", "object", 1), ("more", "null", 1), ("list", "array", 1)], key=repr)
    assert as_set(variants.mistyped(df, "value", S.TXN_SCHEMA, ["n"])) == sorted(
        [(1, "event_id", "number", "2"), (7, "event_id", "boolean", "true"), (1, "amount_minor", "string", "5")], key=repr)
