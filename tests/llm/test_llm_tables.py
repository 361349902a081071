"""Operators that join and group, against plain versions and SQL."""

import functools
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import leaks, near_copies, words
from tillwatch.llm import decontaminate, jaccard, langid, mixing, pii, urls
from tillwatch.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, small, name):
    engine = duckdb.connect()
    for view in ("documents", "benchmark"):
        engine.sql(f"CREATE VIEW {view} AS SELECT * FROM '{small}/{view}.parquet'")
    df, relation = QUERIES[name](spark, small), engine.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(relation.columns)
    order = sorted(df.columns)
    places = [relation.columns.index(c) for c in order]
    assert sorted(map(tuple, df.select(*order).collect())) == sorted(
        tuple(r[i] for i in places) for r in relation.fetchall())


def test_masks_miss_no_stretch_with_two_substitutions():
    n = decontaminate.STRETCH
    for i in range(n):
        for j in range(i, n):
            assert any(all(bit == "0" or at + k not in (i, j) for k, bit in enumerate(mask))
                       for mask in decontaminate.MASKS for at in range(n - len(mask) + 1)), (i, j)


def changed(text, share, rng):
    return " ".join(w if rng.random() > share else f"new{rng.randint(0, 9**9)}" for w in text.split(" "))


def test_leaks_against_all_alignments(spark, small):
    rng = random.Random(3)
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
            if r.text and len(r.text) < 1500]
    for k, (_, text) in enumerate(items[:30]):
        before, after = docs[k][1], docs[k + 30][1]
        part = " ".join(text.split(" ")[rng.randint(0, 8):])
        docs.append((10_000 + k, f"{before} {changed(part, 0.02 * (k % 10), rng)} {after}"))
    for k, (_, text) in enumerate(items[:24]):
        short = " ".join(text.split(" ")[:1 + k % 8])
        items.append((500 + k, short))
        docs += [(20_000 + k, f"{docs[k][1]} {changed(short, 0.1 * (k % 3), rng)}"), (30_000 + k, short.upper())]
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks(docs, items)
    assert len(got) > 20 and all(r.n_same <= r.n_tokens for r in got)


def test_rows_that_share_an_id_are_judged_alone(spark):
    text = "these are the fifteen words of an item that some document has copied as a whole"
    docs = spark.createDataFrame(
        [(i, f"row {n} has nothing of it") for n in range(30) for i in (None, 7)] + [(None, f"so {text}"), (7, text)],
        "doc_id long, text string")
    bench = spark.createDataFrame([(1, text), (None, text)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()), key=repr)
    assert got == sorted([(None, 1), (None, None), (7, 1), (7, None)], key=repr)
    assert decontaminate.clean(docs, bench).count() == 60


def test_leaks_without_broadcast(spark, small, monkeypatch):
    tables = [spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark")]
    before = sorted(map(tuple, decontaminate.contaminated(*tables).collect()))
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    assert sorted(map(tuple, decontaminate.contaminated(*tables).collect())) == before


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.8, 0.99), (0.5, 0.95)):
        bands, rows = jaccard.bands_and_rows(threshold, recall, 128)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= 128


def near_copy_rows(seed):
    rng = random.Random(seed)
    rows = []
    for group in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 40, 120, 200]))]
        for _ in range(rng.choice([1, 2, 5, 14])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                text[rng.randrange(len(text))] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows) * 3, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [256, 3])
def test_near_copies_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard.tiles, "__defaults__", (tile,))
    rows = near_copy_rows(tile)
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == near_copies(rows) and len(got) == len(rows)


def test_near_copies_of_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_join_ngrams"](spark, small).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == near_copies(rows)


def test_units_fit_in_batches_of_any_size(spark):
    rows = near_copy_rows(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == near_copies(rows)


def test_near_copies_in_tiles_and_slices_of_few_ngrams(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_GRAMS", 300)
    monkeypatch.setattr(jaccard, "SLICE_GRAMS", 50)
    rows = near_copy_rows(5)
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == near_copies(rows)


def test_tiles_hold_few_ngrams(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_GRAMS", 1000)
    members = spark.range(6).selectExpr("0 band", "1L key", "6L size", "4500L grams", "id s1", "-id s2")
    units = jaccard.tiles(members).groupBy("part", "other").count().collect()
    assert max(max(u.part, u.other) for u in units) <= 4 and jaccard.tiles(members).count() == 30


def test_near_copies_without_ids(spark):
    rows = near_copy_rows(6)
    nameless = [(None if i % 3 else i, text) for i, text in rows]
    got = jaccard.classes(spark.createDataFrame(nameless, "doc_id long, text string")).collect()
    assert sorted(r.n_links for r in got) == sorted(n for _, n in near_copies(rows).values())
    kept = jaccard.deduplicated(spark.createDataFrame(nameless + nameless, "doc_id long, text string"))
    assert kept.count() == len({c for c, _ in near_copies(rows).values()})


def test_equal_rows_are_read_once_and_kept_once(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, base)] * 300 + [(None, base.replace("w59", "x")), (7, "another text of six words"), (8, None), (8, None)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row int")
    docs = docs.repartition(5)
    wanted = docs.filter("doc_id is null").select(jaccard.row_hash().alias("row_id"))
    for bound in (jaccard.BROADCAST_ROWS, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(jaccard, "BROADCAST_ROWS", bound)
            texts = jaccard.texts_of(docs, wanted).join(wanted.distinct(), "row_id")
            assert sorted(r.text for r in texts.collect()) == sorted({t for i, t in rows if i is None})
    links = sorted(r.n_links for r in jaccard.classes(docs).collect())
    assert links == [0, 0, 0] + [300] * 301
    kept = jaccard.deduplicated(docs)
    assert kept.columns == ["doc_id", "text", "_row"]
    got = kept.collect()
    assert len(got) == 3 and all(rows[r._row] == (r.doc_id, r.text) for r in got)


def test_large_groups_of_copies_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "lookup", functools.partial(jaccard.lookup, rows_per_task=3, limit=-1))
    rows = near_copy_rows(11) * 2
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == near_copies(rows) and len(got) == len(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)] + [("s9", f"s{i}") for i in range(9)] + [("x", "x")]
    random.Random(4).shuffle(edges)
    got = dict(map(tuple, jaccard.components(spark.createDataFrame(edges, "a string, b string")).collect()))
    assert got == {**{f"c{i:02d}": "c00" for i in range(1, 21)}, **{f"s{i}": "s0" for i in range(1, 10)}}


# Valid and invalid values; none belongs to anybody.
VALUES = [
    ("card 4041894974608795, 4041-8949-7460-8795", 2),
    ("no card 4041894974608796", 0),
    ("mail a.b_1@mail8.example.com.", 1),
    ("call +1 (988) 555-2485 or 317-555-3649 or +44 20 7946 0958", 3),
    ("ip 70.123.182.155. not 999.1.1.1 nor 1.2.3.4.5", 1),
    ("ssn 123-45-6789 not 000-12-3456", 1),
    ("on 1984-02-29, 02/29/1984 and 29.02.1984 not 2021-02-30", 3),
    ("DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 not GB83WEST12345698765432", 2),
    ("section 3.4.2, page 12 of 400, 99 percent", 0),
]


def test_pseudonyms_keep_their_format_and_can_be_undone(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(VALUES)], "doc_id long, text string")
    out = pii.pseudonymise(docs).orderBy("doc_id").collect()
    assert [r.n_private for r in out] == [n for _, n in VALUES]
    again = pii.pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"))
    assert [r.n_private for r in again.orderBy("doc_id").collect()] == [n for _, n in VALUES]  # still valid
    back = pii.pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"),
                            inverse=True).orderBy("doc_id").collect()
    assert [r.text for r in back] == [t for t, _ in VALUES]
    for row, (text, n) in zip(out, VALUES):
        assert (row.text != text) == (n > 0)
    linked = out[0].text.split(" ", 1)[1].replace("-", "").split(", ")
    assert linked[0] == linked[1]
    other = pii.pseudonymise(docs, key="another").orderBy("doc_id").collect()
    assert other[0].text != out[0].text


def test_pairs_and_texts_are_permuted(spark):
    pairs = spark.range(150 * 7).select((F.col("id") % 150).alias("x"), F.floor(F.col("id") / 150).alias("y"))
    moved = pairs.select("x", "y", pii.permute_pair(F.col("x"), F.col("y"), 150, 7, "k", "t", False).alias("p"))
    got = {(r.p.x, r.p.y) for r in moved.collect()}
    assert got == {(x, y) for x in range(150) for y in range(7)}
    texts = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("t"))
    moved = {r[0] for r in texts.select(pii.permute_text(F.col("t"), "k", "t", False)).collect()}
    assert moved == {f"{i:03d}" for i in range(1000)}
    long_text = "Ab9-" * 40
    row = spark.createDataFrame([(long_text,)], "t string").select(
        pii.permute_text(F.col("t"), "k", "t", False).alias("m")).first()
    assert [("A" if c.isupper() else "a" if c.islower() else "9" if c.isdigit() else c) for c in row.m] == list("Aa9-" * 40)


def test_personal_data_of_documents_is_replaced(spark, small):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op1_pseudonymise"](spark, small).collect():
        assert (r.text != rows[r.doc_id]) == (r.n_private > 0)
        assert len(words(r.text)) == len(words(rows[r.doc_id]))


def test_mix_meets_its_targets(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "source")
    got = QUERIES["op4_mix_sources"](spark, directory)
    again = QUERIES["op4_mix_sources"](spark, directory)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    df = got.toPandas().merge(docs.toPandas(), on="doc_id")
    sums = df.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"),
                                    target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (sums["size"] == sums.source_size).all() and (df.taken <= 2 * df["size"]).all()
    assert sums.target.sum() == pytest.approx(1.5 * sums["size"].sum())
    assert ((sums.taken - sums.target).abs() <= 0.02 * sums.target).all()


def test_mix_in_ranges(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("source", F.lit("all"))
    whole = {r.doc_id: r for r in mixing.mix(docs).collect()}
    for r in mixing.mix(docs, ranges=7).collect():
        assert (r.size, r.target) == (whole[r.doc_id].size, whole[r.doc_id].target)
    taken = mixing.mix(docs, ranges=7).agg(F.sum("taken"), F.max("target")).first()
    assert abs(taken[0] - taken[1]) < 0.02 * taken[1]


def test_ranges_are_even_for_all_weights(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "word").otherwise("#### word").alias("text"),
        F.lit("all").alias("source"))
    keyed = mixing.keyed(docs, mixing.SEED, 20, ["doc_id"]).groupBy("_range").count().toPandas()
    assert len(keyed) == 20 and keyed["count"].max() < 3 * 1000


def test_mix_takes_smallest_keys_and_one_more(spark):
    rng = random.Random(8)
    rows = [(i, "word " * rng.choice([1, 3, 10, 40, 200]), f"s{i % 3}") for i in range(300)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    name = F.concat("doc_id", F.lit(":"), F.md5("text"))
    keyed = got.withColumn("draw", -F.ln(mixing.unit_hash(name, mixing.SEED))).toPandas()
    for _, g in keyed.groupby("source"):
        passes, g = g.target.iloc[0] // g.source_size.iloc[0], g.sort_values("draw")
        rest = g.target.iloc[0] - passes * g.source_size.iloc[0]
        drawn = (g["size"].cumsum() <= rest).values
        left, sizes = rest - g["size"][drawn].sum(), g["size"].where(~drawn)
        best = (sizes - left).abs()
        if best.min() < left:
            drawn[np.flatnonzero(best == best.min())[0]] = True
        assert (g.taken == g["size"] * (passes + drawn)).all()


@pytest.mark.parametrize("sources", [3, 300, 2000])
def test_every_source_comes_near_its_target(spark, sources):
    docs = spark.range(12_000).select(
        F.when(F.col("id") % 50 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("s"), F.col("id") % sources).alias("source"),
        F.repeat(F.lit("word "), (F.pmod(F.xxhash64("id"), F.lit(9)) ** 4 + 1).cast("int")).alias("text"))
    got = mixing.mix(docs, carried=["source"], ranges=40).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).toPandas()
    off = (got.taken - got.target).abs()
    assert len(got) == sources and (off <= got.most / 2).all() and off.mean() < 0.05 * got.target.mean()


def filled(sizes, weights, total):
    """Targets by resharing the excess again and again."""
    target = [0.0] * len(sizes)
    while total > 1e-6:
        free = [i for i, s in enumerate(sizes) if target[i] < 2 * s - 1e-9]
        weight = sum(weights[i] for i in free)
        given = 0.0
        for i in free:
            more = min(total * weights[i] / weight, 2 * sizes[i] - target[i])
            target[i] += more
            given += more
        total -= given
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 1000]) * rng.randint(1, 9) for _ in range(8)]
    rows = [(f"s{i}", s) for i, s in enumerate(sizes)]
    got = {r._1: r.target for r in mixing.targets(
        spark.createDataFrame(rows, "_key string, source_size long")).withColumnRenamed("_key", "_1").collect()}
    expected = filled(sizes, [(3, 1, 2)[i % 3] for i in range(8)], 1.5 * sum(sizes))
    assert [got[f"s{i}"] for i in range(8)] == pytest.approx(expected, abs=1e-3)


def test_documents_of_more_weight_come_first(spark):
    docs = spark.createDataFrame(
        [(i, "word word" if i % 2 else "#### word", "b") for i in range(2000)]
        + [(-1, "word " * 200, "a"), (-2, "word", "a")], "doc_id long, text string, source string")
    got = mixing.mix(docs).filter("source = 'b'").toPandas()
    twice = got[got.taken > got["size"]]
    assert (got.taken >= got["size"]).all() and (twice.doc_id % 2).mean() > 0.6


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in urls.POLICY:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith(f".{name}")) and path.startswith(f"/{rest}"):
            best = max(best or ("", ""), (rule, verdict), key=lambda r: len(r[0]))
    return host, path, best


URLS = [None, "", "no scheme", "http://", "http://COM/", "https://a.Example.com/en/x?y#z", "http://www.example.com/en/1",
        "http://x.www.example.com/en/", "http://example.com/en", "http://notexample.com/en/", "http://b.net/es/", "net/es/",
        "http://b.net/es?x", "http://com?x/", "ftp://b.net/fr/x://y", "http://example.com#/en/", "a\nb://c.net/fr/\nd?e"]


def test_policy_against_plain_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for row in urls.judge(df).collect():
        host, path, best = plain_rule(URLS[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, best and best[0]), row
        if best:
            assert row.verdict == best[1]


def plain_rules(baskets, min_support, min_confidence, most):
    """All rules token set -> verdict by counting every subset."""
    from collections import Counter
    from itertools import combinations

    with_class, alone = Counter(), Counter()
    for items, verdict in baskets:
        for k in range(1, most + 1):
            for subset in combinations(sorted(items), k):
                alone[subset] += 1
                with_class[subset, verdict] += 1
    n = len(baskets)
    rules = {(s, v): c / alone[s] for (s, v), c in with_class.items()
             if c >= np.ceil(min_support * n) and c / alone[s] >= min_confidence}
    return {(s, v): c for (s, v), c in rules.items()
            if not any(rules.get((s[:i] + s[i + 1:], v), 0) >= c for i in range(len(s)))}


def test_mined_rules_and_verdicts_against_counting(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    host, path = urls.host_and_path(F.col("url"))
    rule, verdict = urls.policy_rule(host, path)
    rows = [tuple(r) for r in pages.select(
        "page_id", urls.tokens(F.col("url"), host, path), verdict).collect()]
    baskets = [(items, v) for _, items, v in rows if v]
    expected = plain_rules(baskets, 0.05, 0.9, 3)
    labelled = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    got = urls.mine(labelled, 0.05, 0.9, 3).collect()
    assert {(tuple(r["items"]), r.verdict) for r in got} == set(expected)
    for r in got:
        assert r.confidence == pytest.approx(expected[tuple(r["items"]), r.verdict])
    judged = {r.page_id: r for r in urls.judge(pages, min_support=0.05, most_tokens=3).collect()}
    ids = {r.rule_id: r for r in got}
    for page, items, policy in rows:
        fits = [r for r in got if set(r["items"]) <= set(items)]
        best = max(fits, key=lambda r: (r.confidence, r.support, -len(r["items"]), r.rule_id), default=None)
        assert judged[page].mined == (best and best.rule_id) and judged[page].verdict == (
            policy or (best.verdict if best else "allow")) and (best is None or best.rule_id in ids)


def test_pipeline_stages_against_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language"](spark, docs, small)
    assert told.count() == len(rows)  # all have letters and a language
    one_each = stages["near_duplicates"](spark, told, small)
    kept = {i for i, (root, _) in near_copies(rows).items() if i == root}
    assert sorted(r.doc_id for r in one_each.collect()) == sorted(kept)
    clean = stages["benchmark"](spark, one_each, small)
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {doc for doc, _ in leaks([r for r in rows if r[0] in kept], items)}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(kept - bad)
    changed_rows = stages["personal_data"](spark, clean, small)
    assert changed_rows.columns == docs.columns and changed_rows.filter("n_chars != length(text)").count() == 0
    mixed = stages["mix"](spark, changed_rows, small).toPandas()
    sizes = changed_rows.toPandas().assign(size=lambda d: d.text.map(lambda t: len(words(t))))
    assert abs(mixed["size"].sum() - 1.5 * sizes["size"].sum()) < 0.1 * sizes["size"].sum()
    assert mixed.groupby("doc_id").size().max() <= 2
    run = corpus_pipeline.run(spark, small).toPandas()
    columns = ["doc_id", "pass", "text"]
    assert sorted(map(tuple, run[columns].values)) == sorted(map(tuple, mixed[columns].values))


# Values beside other numbers, with the part that must not stay.
NEIGHBOURS = [
    ("4111 1111 1111 1111 12/27", "4111 1111 1111 1111", 1),
    ("4111 1111 1111 1111 123", "4111 1111 1111 1111", 1),
    ("4111111111111111 100 EUR", "4111111111111111", 1),
    ("2 4111-1111-1111-1111", "4111-1111-1111-1111", 1),
    ("3782 822463 10005 2024 7", "3782 822463 10005", 1),
    ("7 41111 11111 111111 5", "41111 11111 111111", 1),
    ("BE68539007547034 2024", "BE68539007547034", 1),
    ("BE68 5390 0754 7034 EUR", "BE68 5390 0754 7034", 1),
    ("BE68539007547034 4111-1111-1111-1111", "4111-1111-1111-1111", 2),
    ("AB12 3456 4111 1111 1111 1111", "4111 1111 1111 1111", 1),
    ("12 123-45-6789 4000", "123-45-6789", 1),
    ("317-555-3649 317-555-3650", "317-555-3650", 2),
    ("1234 5678 9012 3 jo5@mail8.example.com", "jo5@", 1),
    ("1234 5678 9012 3 70.123.182.155", "70.123.182.155", 1),
]


def test_neighbours_hide_no_value(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(NEIGHBOURS)], "doc_id long, text string")
    for r in pii.pseudonymise(docs).collect():
        text, value, n = NEIGHBOURS[r.doc_id]
        assert r.n_private == n and value not in r.text, (text, r)


def test_short_items_and_scripts_without_blanks(spark):
    items = [(1, "法国的首都是哪座城市"), (2, "What is two plus two?"), (3, "東京はどこ"), (4, "เมืองหลวงของไทยคือ"), (5, "Yes")]
    docs = [(1, "前文。法国的首都是哪座城市？后文"), (2, "so: what IS two, plus two"), (3, "ここで東京はどこですか"),
            (4, "ถามว่าเมืองหลวงของไทยคืออะไร"), (5, "yes"), (6, "what is two plus three 法国的首都 東京は"), (7, "法国的首都也是那座大城市")]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(1, 6)}
    assert all(r.n_same == r.n_tokens for r in got)


def test_deep_tokens_and_long_rules(spark):
    deep = ["http://a.b.c.d.e.net/x/y/casino/?q=u&r=u&s=u&t=bad"]
    got = spark.createDataFrame([(u,) for u in deep], "url string").select(
        urls.tokens(F.col("url"), *urls.host_and_path(F.col("url"))).alias("t")).first().t
    assert {"host5:b", "host6:a", "path3:casino", "query:t=bad", "labels:6"} <= set(got)
    five = list("abcde")
    rows = [(five, "block")] * 30 + [([x for x in five if x != y], "allow") for y in five for _ in range(30)]
    rules = urls.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.1, 0.9).collect()
    assert [(r["items"], r.verdict) for r in rules] == [(five, "block")]


def test_tables_of_numbers_are_left_alone(spark):
    rng = random.Random(5)
    lines = [" ".join(f"{rng.randint(10, 99)}" for _ in range(20)) for _ in range(100)]
    lines += [" ".join(f"{rng.randint(1900, 2024)}" for _ in range(5)) for _ in range(100)]
    lines += [" ".join(f"{rng.randint(100, 999)}" for _ in range(12)) for _ in range(100)]
    lines += ["1234 5678 9012 3 456", "5 12 7 123 44 99 812"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert [r.text for r in pii.pseudonymise(docs).filter("n_private > 0").collect()] == []


def test_tokens_that_stand_together_are_mined_as_one(spark):
    path = "/".join(f"s{i}" for i in range(40))
    pages = [(i, f"http://a{i}.example.com/en/{path}") for i in range(100)]
    pages += [(100 + i, f"http://b{i}.com/other") for i in range(100)] + [(200, f"http://c.org/en/{path}")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert got[200].verdict == "block" and got[0].rule == "example.com/en/" and got[100].verdict == "allow"
    rows = [(["a", "b", "c"], "block")] * 30 + [(["a", "b", "d"], "allow")] * 30 + [(["c"], "allow")] * 30
    mined = urls.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.1, 0.9).collect()
    assert sorted((r["items"], r.verdict) for r in mined) == [
        (["a", "c"], "block"), (["b", "c"], "block"), (["d"], "allow")]
