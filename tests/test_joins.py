import random

import pytest
from pyspark.sql import functions as F

from helpers import as_set, column, frame
from tillwatch.operators import enrich as E, serving
from tillwatch.operators.joins import asof_lookup, fits_broadcast, hot_keys, lookup
from tillwatch.operators.latest import latest_by_key
from tillwatch.plans.dataset import Dataset


def skewed(spark, rows=900):
    """A third of the rows on one key, some of them identical, some null keys, the rest spread out."""
    rng = random.Random(3)
    data = []
    for i in range(rows):
        key = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{rng.randrange(60)}"
        data.append({"key": key, "n": 0 if i % 6 == 0 else i})
    return frame(spark, "key string, n int", *data), data


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_key_uses_the_last_order_column_for_ties(spark):
    rows = frame(
        spark, "k string, t int, id string, v string",
        {"k": "a", "t": 1, "id": "1", "v": "old"}, {"k": "a", "t": 2, "id": "1", "v": None},
        {"k": "b", "t": 1, "id": "1", "v": "x"}, {"k": "b", "t": 1, "id": "2", "v": "y"},
    )
    assert as_set(latest_by_key(rows, "k", ["t", "id"])) == [("a", 2, "1", None), ("b", 1, "2", "y")]


def test_latest_by_key_aggregates_before_the_shuffle(spark):
    rows, _ = skewed(spark)
    assert "partial_max_by" in plan(latest_by_key(rows, "key", ["n"]))


def test_hot_keys_finds_the_key_and_the_nulls(spark):
    rows, data = skewed(spark)
    found = hot_keys(rows, "key", rows_per_task=50)
    copies = {key: -(-sum(row["key"] == key for row in data) // 50) for key in ("hot", None)}
    assert sorted(found, key=repr) == sorted(copies.items(), key=repr)
    assert hot_keys(rows, "key", rows_per_task=10_000) == []
    assert hot_keys(rows.filter("false"), "key") == []
    assert hot_keys(rows.filter("key IS NULL"), "key", rows_per_task=50) == [(None, copies[None])]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_the_plain_join(spark, how):
    rows, _ = skewed(spark)
    table = frame(spark, "key string, v int", {"key": "hot", "v": -1}, *[{"key": f"k{i}", "v": i} for i in range(40)])
    salted = lookup(rows, table, "key", how, rows_per_task=20, limit=-1)
    assert "_salt" not in salted.columns
    assert as_set(salted) == as_set(rows.join(table, "key", how))


def test_salting_spreads_identical_copies(spark):
    rows = spark.range(0, 4000, 1, 16).select(F.lit("hot").alias("key"), F.lit(1).alias("n"))
    from tillwatch.operators import joins

    spread = joins._spread(rows, "key", [("hot", 8)], rows.columns)
    assert spread.select("_salt").distinct().count() > 4


def test_small_tables_are_broadcast_and_large_ones_are_not(spark):
    rows, _ = skewed(spark)
    table = spark.range(100).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("v"))
    assert fits_broadcast(table) and "BroadcastHashJoin" in plan(lookup(rows, table, "key"))
    assert not fits_broadcast(table, limit=10)
    assert "SortMergeJoin" in plan(lookup(rows.hint("merge"), table.hint("merge"), "key", limit=10))
    wide = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    joined = wide.join(table.hint("merge"), "key", "left").join(table.withColumnRenamed("v", "w"), "key", "left")
    assert fits_broadcast(joined)
    assert not fits_broadcast(joined, limit=5000)


def test_every_hot_key_is_found_however_many(spark):
    """More of them than a frequency sketch of 10,000 entries tells apart."""
    rows = spark.range(12_000 * 3).select((F.col("id") % 12_000).cast("string").alias("key"))
    rows = rows.unionByName(spark.range(12_000, 40_000).select(F.col("id").cast("string").alias("key")))
    found = hot_keys(rows, "key", rows_per_task=2)
    assert len(found) == 12_000 and {copies for _, copies in found} == {2}


def test_shuffled_queries_shuffle(spark, small):
    from tillwatch.plans.queries import QUERIES

    for name in ("enrich_txn_shuffled", "fraud_by_category_day_shuffled"):
        merged = [line for line in plan(QUERIES[name](spark, small)).splitlines() if "SortMergeJoin" in line]
        for key in ("card_ref", "party_id", "merchant_id"):
            assert any(f"[{key}#" in line and "LeftOuter" in line for line in merged), (name, key)
        assert any("_salt" in line for line in merged), name


def brute_asof(facts, versions):
    out = []
    for fact in facts:
        eligible = [v for v in versions if v["key"] == fact["key"] and fact["key"] is not None
                    and fact["t"] is not None and v["vt"] <= fact["t"]]
        best = max(eligible, key=lambda v: (v["vt"], v["id"])) if eligible else {"vt": None, "id": None}
        out.append((fact["key"], fact["n"], fact["t"], best["vt"], best["id"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
@pytest.mark.parametrize("rows_per_task", [7, 1_000_000])
def test_asof_equals_brute_force(spark, bucket, rows_per_task):
    import datetime as dt

    rng = random.Random(11)
    base = dt.datetime(2024, 1, 31, 22)
    at = lambda: base + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 40, 30))
    facts = [{"key": "hot" if i % 3 == 0 else None if i % 31 == 1 else f"k{rng.randrange(6)}", "n": i,
              "t": None if i % 29 == 2 else base if i % 9 == 0 else at()} for i in range(240)]
    versions = [{"key": rng.choice(["hot", "k0", "k1", "k2", "k3", "never"]), "vt": at(), "id": i} for i in range(90)]
    versions += [{"key": "hot", "vt": base, "id": 900 + i} for i in range(3)]
    got = asof_lookup(
        frame(spark, "key string, n int, t timestamp_ntz", *facts),
        frame(spark, "key string, vt timestamp_ntz, id int", *versions),
        "key", "t", "vt", ["id"], bucket=bucket, rows_per_task=rows_per_task,
    )
    assert as_set(got.select("key", "n", "t", "vt", "id")) == brute_asof(facts, versions)


USER = "party_id string, first string, tag string"
CARD = "card_ref string, party_id string, tag string"
MERCHANT = "merchant_id string, category string, tag string"
TXN = "event_id string, card_ref string, merchant_ref string, amount_minor int"


def entities(spark):
    cards = frame(spark, CARD, {"card_ref": "c1", "party_id": "u1", "tag": "card"},
                  {"card_ref": "c2", "party_id": "ghost"})
    users = frame(spark, USER, {"party_id": "u1", "first": "Ann", "tag": "user"})
    return cards, users, frame(spark, MERCHANT, {"merchant_id": "m1", "category": "FOOD", "tag": "merchant"})


@pytest.mark.parametrize("limit", [None, -1])
def test_chained_lookups_keep_misses(spark, limit):
    txns = frame(
        spark, TXN,
        {"event_id": "1", "card_ref": "c1", "merchant_ref": "m1"}, {"event_id": "2", "card_ref": "c2"},
        {"event_id": "3", "card_ref": "nope", "merchant_ref": "m1"}, {"event_id": "4"},
        {"event_id": "5", "card_ref": "c1", "merchant_ref": "nope"},
    )
    out = E.enrich(txns, *entities(spark), limit=limit, rows_per_task=1)
    got = as_set(out.select("event_id", "first", "category", "card_found", "user_found", "merchant_found", "tag"))
    assert got == [
        ("1", "Ann", "FOOD", True, True, True, "merchant"),
        ("2", None, None, True, False, False, None),
        ("3", None, "FOOD", False, False, True, "merchant"),
        ("4", None, None, False, False, False, None),
        ("5", "Ann", None, True, True, False, "card"),
    ]
    categories = out.select(E.category_of_row().alias("c"))
    assert sorted(column(categories, "c")) == ["FOOD", "FOOD", "UNK", "UNK", "UNK"]


def test_gate_orphans_and_audit_agree(spark):
    txns = frame(spark, TXN, *[{"event_id": str(i), "card_ref": ref, "merchant_ref": "m1"}
                               for i, ref in enumerate(["c1", "c1", "c2", "x", None])])
    cards, users, merchants = entities(spark)
    assert sorted(column(E.matched_only(txns, cards), "event_id")) == ["0", "1", "2"]
    assert sorted(column(E.orphans(txns, cards, "card_ref", "card_ref"), "event_id")) == ["3", "4"]
    audit = {r["lookup"]: (r["misses"], r["total"]) for r in E.miss_audit(
        E.enrich(txns, cards, users, merchants)).collect()}
    assert audit == {"card": (2, 5), "user": (3, 5), "merchant": (0, 5)}


def test_clean_data_has_no_orphans(spark, small):
    """Every order line belongs to a customer, and every one of them to a supplier."""
    from tillwatch.sources import tables

    lines = tables.raw_line_txns(spark, small)
    customers = tables.read_table(spark, small, "customer").selectExpr("cast(c_custkey AS string) AS card_ref")
    assert E.orphans(lines, customers, "card_ref", "card_ref").count() == 0


def test_unknown_city_gets_defaults(spark):
    users = frame(spark, "party_id string, location_id_home string, home_latitude double, home_longitude double",
                  {"party_id": "a", "location_id_home": "VN-HN-01", "home_latitude": 0.0, "home_longitude": 0.0},
                  {"party_id": "b", "location_id_home": "nowhere", "home_latitude": 0.0, "home_longitude": 0.0},
                  {"party_id": "c", "home_latitude": 1.0, "home_longitude": 2.0})
    plain = as_set(serving.with_city(users).select("party_id", "city", "lat", "city_pop", "home_latitude"))
    assert plain == [("a", "Ha Noi", 21.0278, 8000000, 0.0), ("b", "Unknown", 0.0, 0, 0.0), ("c", "Unknown", 0.0, 0, 1.0)]
    filled = serving.with_city(users, home_from_city=True).select("party_id", "home_latitude")
    assert as_set(filled) == [("a", 21.0278), ("b", 0.0), ("c", 1.0)]


def test_scoring_plan_has_no_python_and_prunes_columns(spark, small):
    from tillwatch.plans.queries import QUERIES

    text = plan(QUERIES["fraud_by_category_day"](spark, small))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "l_comment" not in text and "c_name" not in text
    assert text.count("Exchange hashpartitioning") <= 4


def test_served_entities_have_one_row_per_key(spark, small):
    for df, key in zip(Dataset(spark, small).entities(), ("card_ref", "party_id", "merchant_id")):
        assert df.groupBy(key).count().filter("count > 1").count() == 0


@pytest.mark.parametrize("limit", [None, 0, -1])
def test_cards_by_way_of_orders_equal_cards_named(spark, limit):
    """Equal orders, orders without a card and lines without an order; the lines themselves are shuffled once for card and user."""
    lines = frame(
        spark, "event_id string, order_ref bigint, merchant_ref string, amount_minor int",
        *[{"event_id": str(i), "order_ref": None if i == 7 else i % 6, "merchant_ref": str(i % 3), "amount_minor": i} for i in range(40)])
    orders = frame(spark, "order_ref bigint, card_ref string", {"order_ref": 0, "card_ref": "a"}, {"order_ref": 0, "card_ref": "a"},
                   {"order_ref": 1, "card_ref": None}, {"order_ref": 2, "card_ref": "b"}, {"order_ref": 3, "card_ref": "gone"},
                   {"order_ref": 4, "card_ref": "a"})
    cards = frame(spark, "card_ref string, party_id string", {"card_ref": "a", "party_id": "p"}, {"card_ref": "b"})
    users = frame(spark, "party_id string, age int", {"party_id": "p", "age": 3})
    merchants = frame(spark, "merchant_id string, category string", {"merchant_id": "1", "category": "FOOD"})
    options = {"rows_per_task": 2, "limit": limit}
    found = E.enrich(lines, cards, users, merchants, through=orders, skew_from={"card_ref": orders.select("card_ref")}, **options)
    named = E.enrich(lines.join(orders, "order_ref"), cards, users, merchants, **options)
    assert as_set(found.select(*named.columns)) == as_set(named) and found.count() == 40
    if limit == -1:
        facts = [line for line in plan(found).splitlines() if "hashpartitioning(order_ref" in line]
        assert len(facts) == 2


def test_many_narrow_rows_are_shuffled_though_spark_thinks_them_few(spark, tmp_path):
    wide = spark.range(20_000).selectExpr("id", "repeat(cast(id AS string), 40) AS text")
    wide.write.parquet(str(tmp_path / "wide"))
    narrow = spark.read.parquet(str(tmp_path / "wide")).select("id")
    from tillwatch.operators.joins import _input_bytes, plan_bytes, shuffled_unless_small

    between = (plan_bytes(narrow) + _input_bytes(narrow)) // 2
    rows = spark.range(50)
    assert "SortMergeJoin" in plan(rows.join(shuffled_unless_small(narrow, between), "id"))
    assert shuffled_unless_small(narrow, _input_bytes(narrow)) is narrow
    assert as_set(rows.join(shuffled_unless_small(narrow, between), "id")) == sorted([(i,) for i in range(50)], key=repr)
