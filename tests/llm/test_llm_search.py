"""Ranked search against scores of all documents, and the bounds it skips by."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillwatch.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, size=20):
    """Sorted (item_id, rank, doc_id, score), scoring every document."""
    counts = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            norm = 12 * (75 + (25 * sum(c.values()) * n) // length)
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + norm)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc, score))
        out += [(item, rank, d[2], d[3]) for rank, d in enumerate(sorted(scores, key=lambda d: (d[0], d[1], d[2] or 0))[:size], 1)]
    return sorted(out, key=repr)


def text(rng, n, words):
    # Frequent words first, as in real texts.
    return " ".join(rng.choice(["", "É"]) + f"w{int(words * rng.random() ** 3)}" for _ in range(n))


def tables(seed):
    rng = random.Random(seed)
    docs = [(i, text(rng, rng.randint(0, 60), 400)) for i in range(600)]
    docs += [(700 + i, docs[5][1]) for i in range(60)] + [(None, docs[5][1]), (1, docs[9][1]), (1, docs[9][1])]
    docs += [(800, None), (801, ""), (802, "-- !"), (803, text(rng, 20_000, 400))]
    items = [(i, text(rng, rng.randint(1, 40), 500)) for i in range(25)] + [(30, docs[5][1]), (31, None), (32, ""),
             (33, "never seen"), (34, "W1 w1 W1, w2"), (34, "w3"), (None, "w0 w4")]
    return docs, items


@pytest.mark.parametrize("block, at_once", [(4096, 1000), (16, 1000), (50, 7)])
def test_ranks_against_all_scores(spark, block, at_once):
    """Blocks end with their partition, so there are many small ones too."""
    docs, items = tables(block)
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(max(2, len(docs) // block))
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = search.search(given, queries, at_once=at_once).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == plain(docs, items)


def a_block(rng, n_terms, n_docs):
    lists = [sorted(rng.sample(range(n_docs), rng.randint(1, n_docs))) for _ in range(n_terms)]
    places = np.array([p for one in lists for p in one])
    return search.Block(pa.array(range(n_docs)), np.full(n_docs, 50), np.arange(n_terms),
                        np.cumsum([0, *map(len, lists)]), places, np.ones(len(places), np.int64))


def test_bounds_hold_and_pairs_tighten_them():
    rng = random.Random(4)
    tighter = 0
    for _ in range(200):
        block = a_block(rng, 6, 12)
        impact = np.array([rng.randint(1, 100) for _ in block.places])
        query = search.Query(np.arange(6), np.array([rng.randint(1, 3) for _ in range(6)]), 0)
        single, joint = search.greatest(block, query, impact)
        bounds = search.added_at_most(single, joint)
        dense = np.zeros((6, 12), np.int64)
        for t in range(6):
            own = slice(block.starts[t], block.starts[t + 1])
            dense[t, block.places[own]] = impact[own] * query.times[t]
        for k in range(7):
            assert dense[:k].sum(axis=0).max(initial=0) <= bounds[k] <= single[:k].sum()
        tighter += bounds[6] < single.sum()
        whole = dense.sum(axis=0)
        for least in (1, 150, 300, int(whole.max()), int(whole.max()) + 1):
            found, scores = search.scored(block, query, impact, bounds, least)
            assert dict(zip(found.tolist(), scores.tolist())) == {i: s for i, s in enumerate(whole.tolist()) if s >= least}
    assert tighter > 100


def test_pairs_spare_lists(monkeypatch):
    """Two terms that never meet add no more than one of them, so a block that has both is not read."""
    block = search.Block(pa.array([1, 2]), np.array([5, 5]), np.array([0, 1]), np.array([0, 1, 2]), np.array([0, 1]),
                         np.array([1, 1]))
    query, impact = search.Query(np.array([0, 1]), np.array([1, 1]), 0), np.array([60, 70])
    bounds = search.added_at_most(*search.greatest(block, query, impact))
    assert bounds == [0, 60, 70]
    monkeypatch.setattr(search, "lists_of", lambda *_: pytest.fail("read"))
    assert len(search.scored(block, query, impact, bounds, 71)[0]) == 0


def test_other_ids_more_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "One two.", 1), ("a", "one TWO", 2), (None, "two one", 3), ("z", "three", 4), ("y", "four", 5),
                                  ("x", "five", 6), ("w", "six", 7)], "doc_id string, text string, score int")
    items = spark.createDataFrame([("q", "one", 1)], "item_id string, text string, rank int")
    got = search.search(docs, items, 2)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [r.doc_id for r in got.orderBy("rank").collect()] == ["a", "b"]
    assert search.search(docs.limit(0), items).count() == 0 and search.search(docs, items.limit(0)).count() == 0
