"""Exact deduplication against grouping in plain Python, and its odd cases."""

import hashlib
import random
from collections import defaultdict

import pytest

from tillwatch.llm import exact

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """(doc_id, text) rows as a sorted list of (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(UPPER)].append(doc)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, -(i or 0)))):
            out.append((i, keep, len(ids), n == 0, sha))
    return sorted(out, key=repr)


def rows(seed):
    rng = random.Random(seed)
    texts = ["", None, "A", "a", "É", "é", "x" * 100_000, "X" * 100_000, "x" * 99_999 + "y", "same Head " * 9 + "1",
             "same head " * 9 + "2"]
    out = [(rng.choice([None, *range(40)]), rng.choice(texts)) for _ in range(150)]
    return out + [(rng.randrange(500), "one hot text that a third of the rows have") for _ in range(400)]


@pytest.mark.parametrize("ranges", [1, 3, 24])
def test_groups_against_plain_grouping(spark, ranges):
    given = rows(ranges)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    got = exact.classes(docs, ranges=ranges).select("doc_id", *exact.COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain(given)


def test_a_hot_group_is_cut_into_ranges(spark):
    docs = spark.createDataFrame([(i, "the same text") for i in range(3000)], "doc_id long, text string")
    found = exact.runs(docs, ["doc_id"], 12)
    sizes = [r["count"] for r in found.groupBy("_part").count().collect()]
    assert len(sizes) > 6 and max(sizes) < 900
    whole = exact.classes(docs, ranges=12)
    assert {tuple(r) for r in whole.select("keep_id", "group_size").distinct().collect()} == {(2999, 3000)}
    assert [r.doc_id for r in whole.filter("kept").collect()] == [2999]


def test_texts_that_share_a_key_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: exact.F.lit(1).cast("long"))
    given = [(i, f"a head of thirty-two characters and {i % 3}") for i in range(200)]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    got = exact.classes(docs, ranges=5).select("doc_id", *exact.COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain(given)


def test_odd_ids_columns_and_empty_tables(spark):
    schema = "doc_id string, text string, kept string, keep_id int, n_chars long"
    docs = spark.createDataFrame([("b", "T", "mine", 1, 1), ("a", "t", "mine", 2, 1), (None, None, None, None, None)], schema)
    got = exact.deduplicated(docs, 3)
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [("b", "T", "mine", 1, 1), (None, None, None, None, None)], key=repr)
    assert exact.classes(docs.limit(0)).count() == 0 and exact.deduplicated(docs.limit(0)).count() == 0
