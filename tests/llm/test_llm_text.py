"""Language, quality and licence operators, the language model and the arrays they use."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brute import words
from tillwatch.llm import cascade, fm, langid, licenses, lm
from tillwatch.llm.arrays import Piece, pieces
from tillwatch.llm.queries import QUERIES

TEXTS = ["", "one", " two  words\n", "a\x0bb\x0cc é€ \U0001f600x", "aa bb aa bb aa bb aa bb", "\n\nline\n line\nline\n"]


def piece(texts=TEXTS):
    return next(pieces(pa.array(texts)))[1]


def test_words_of_a_piece_are_those_of_a_pattern():
    p = piece()
    found = [p.data[a:b].tobytes().decode() for a, b in zip(*p.words)]
    assert [found[a:b] for a, b in zip(p.word_offsets, p.word_offsets[1:])] == [words(t) for t in TEXTS]
    spelled = {}
    for word, value in zip(found, p.word_hashes):
        assert spelled.setdefault(word, value) == value
    assert len(set(spelled.values())) == len(spelled)


def test_pieces_cut_between_texts_alone():
    texts = ["x" * random.Random(1).randint(0, 50) for _ in range(100)] + [None, "y" * 500]
    got = []
    for row, p in pieces(pa.array(texts).slice(3), size=64):
        assert row == len(got)
        got += [p.data[a:b].tobytes().decode() for a, b in zip(p.offsets, p.offsets[1:])]
    assert got == [t or "" for t in texts[3:]]
    assert list(pieces(pa.array([], pa.string()))) == []


def test_grams_stay_in_their_text():
    one, many = "Ab c", ["", "Ab c", "zz", "Ab c"]
    alone, _ = langid.grams(piece([one]))
    packed, offsets = langid.grams(piece(many))
    assert [len(x) for x in np.split(packed, offsets[1:-1])] == [1, 5, 3, 5]
    assert (packed[offsets[1]:offsets[2]] == alone).all() and (packed[offsets[3]:] == alone).all()
    spelled = b"  ab c  "
    assert [int.from_bytes(spelled[i:i + 4], "little") for i in range(5)] == alone.tolist()


@pytest.mark.parametrize("n_languages", [2, 9, 70])
def test_filters_return_every_language_of_an_ngram(n_languages):
    rng = np.random.default_rng(n_languages)
    known = {f"l{i:02d}": set(rng.integers(0, 1 << 32, 300).tolist()) for i in range(n_languages)}
    filters = langid.built(np.repeat(sorted(known), [len(known[k]) for k in sorted(known)]),
                           np.concatenate([list(known[k]) for k in sorted(known)]))
    p = piece(["some words to look up", "others"])
    packed, offsets = langid.grams(p)
    plain = [[np.mean([g in known[k] for g in packed[a:b].tolist()]) for k in sorted(known)]
             for a, b in zip(offsets, offsets[1:])]
    assert np.abs(langid.shares(p, filters) - plain).max() < 0.2
    inside = np.array(sorted(known["l01"]))
    rows = langid.rows_of(inside, len(filters.tables[0]))
    assert all((filters.tables[0][r] >> filters.tables[0].dtype.type(1) & 1).all() for r in rows)


def test_languages_of_held_out_texts(spark):
    directory = "/root/testdata/sf0.01"
    got = QUERIES["op2_identify_language"](spark, directory).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{directory}/documents.parquet").toPandas().set_index("doc_id")
    out = got[got.held_out]
    assert len(got) == len(docs) and 100 < len(out) < 300
    assert (out.lang_pred == docs.lang[out.index]).mean() > 0.98 and got.score.between(0, 1).all()


def test_pairwise_interactions_by_squares():
    rng = np.random.default_rng(0)
    machine = fm.Machine(0.3, rng.normal(size=fm.SIZE), rng.normal(size=(fm.SIZE, 4)))
    number, value, offsets = fm.features(piece(TEXTS))
    fast = fm.raw_scores(machine, number, value, offsets)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        n, x = number[a:b], value[a:b].astype(float)
        slow = 0.3 + machine.weights[n] @ x
        slow += sum((machine.factors[n[j]] @ machine.factors[n[k]]) * x[j] * x[k]
                    for j in range(len(n)) for k in range(j))
        assert fast[i] == pytest.approx(slow, rel=1e-4)


def test_quality_of_held_out_rows(spark):
    directory = "/root/testdata/sf0.01"
    got = QUERIES["op6_score_quality"](spark, directory).toPandas().set_index("doc_id")
    again = QUERIES["op6_score_quality"](spark, directory).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{directory}/labels.parquet").toPandas().set_index("doc_id")
    out = got[got.held_out].join(labels, how="inner")
    assert (out.predicted == out.quality).mean() > 0.95
    assert (got.score.sort_index() == again.score.sort_index()).all()


def test_rules_run_by_rejections_per_second():
    rules = [cascade.Rule(n, None) for n in "abc"]
    figures = [{"rule": 0, "seconds": 2.0, "n": 9, "rejected": 4}, {"rule": 1, "seconds": 0.1, "n": 9, "rejected": 1},
               {"rule": 2, "seconds": 1.0, "n": 9, "rejected": 0}]
    assert [r.name for r in cascade.ordered(rules, figures)] == ["b", "a", "c"]
    assert [r.name for r in cascade.ordered(rules, [])] == ["a", "b", "c"]


def test_a_rule_sees_what_others_let_pass_and_order_does_not_matter():
    seen = []

    def counting(test):
        def rejects(p):
            texts = [p.data[a:b].tobytes().decode() for a, b in zip(p.offsets, p.offsets[1:])]
            seen.append(len(texts))
            return np.array([test(t) for t in texts])

        return rejects

    rules = [cascade.Rule("short", counting(lambda t: len(t) < 3)), cascade.Rule("a", counting(lambda t: "a" in t))]
    texts = ["abc", "x", "xyz", "", "bcd"]
    assert cascade.verdicts(piece(texts), rules).tolist() == [False, False, True, False, True] and seen == [5, 3]
    assert cascade.verdicts(piece(texts), rules[::-1]).tolist() == [False, False, True, False, True]


def test_measured_rules(spark):
    docs = spark.createDataFrame([(i, "### " * (i % 2) + "some plain words") for i in range(50)], "doc_id long, text string")
    figures = {f["rule"]: f for f in cascade.measured(docs)}
    assert figures[0]["n"] == 50 and figures[0]["rejected"] == 25 and figures[1]["rejected"] == 0


@pytest.mark.parametrize("text, names, permissive", [
    ("MIT", {"mit"}, True),
    ("MIT OR GPL-3.0-only", {"mit", "gpl-3.0-only"}, True),
    ("MIT AND GPL-3.0-only", {"mit", "gpl-3.0-only"}, False),
    ("GPL-2.0+ WITH Classpath-exception-2.0", {"gpl-2.0+"}, False),
    ("MIT OR Apache-2.0 AND GPL-3.0-only", {"mit", "apache-2.0", "gpl-3.0-only"}, True),
    ("(MIT OR Apache-2.0) AND GPL-3.0-only", {"mit", "apache-2.0", "gpl-3.0-only"}, False),
    ("Apache-2.0 with LLVM-exception or Zlib */", {"apache-2.0", "zlib"}, True),
    ("MIT and more prose", None, None),
])
def test_licence_expressions(text, names, permissive):
    got = licenses.evaluated(text)
    if names is None:
        assert got[0] == {"mit", "more"}
    else:
        assert got == (names, permissive)


@pytest.mark.parametrize("text", ["", "or MIT", "MIT or", "(MIT", "MIT)", "MIT (ISC", "( )", "and"])
def test_broken_licence_expressions(text):
    assert licenses.evaluated(text) is None


def test_licence_phrases_against_a_pattern(spark, small):
    got = QUERIES["op8_scan_licenses"](spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for row in got:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row.doc_id] or "")
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(found))
                  if found[i:i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        assert (row.n_words, row.n_base) == (len(found), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        base = sorted({label for _, label in places})
        assert row.base_labels == ",".join(base) and set(base) <= set(row.labels.split(",")) | {""}
        assert 0 <= row.score <= 1


def test_licence_places_may_overlap():
    row = licenses.Scanner().scan("CC-BY CC, by! SPDX-License-Identifier: (MIT or ISC)\nAll Rights\nReserved")
    assert row[1:6] == (3, 0, 10, "cc-by,reserved", "cc-by,reserved,spdx:isc,spdx:mit") and row[7] is True
    phrase = licenses.Scanner()
    phrase.notices = licenses.automaton({" a a ": ("x", True)})
    assert phrase.scan("a a a")[1:4] == (2, 0, 1)


def test_licence_scan_of_a_long_line():
    n = 30_000
    began = time.perf_counter()
    row = licenses.Scanner().scan("some words cc by SPDX-License-Identifier: MIT or ISC " * n)
    assert row[:4] == (10 * n, n, 2, 10 * n - 8) and row[5] == "cc-by,spdx:isc,spdx:mit" and row[7] is True
    assert time.perf_counter() - began < 20
    assert licenses.evaluated("MIT and\nISC") is None and licenses.evaluated("see MIT\nISC", 4) == ({"mit"}, True)


def test_sides_stop_at_the_text():
    left, right = lm.sides(np.array([1, 2, 3, 4]), np.array([0, 0, 0, 1]), 9)
    assert left.tolist() == [9, 1, 2, 9] and right.tolist() == [2, 3, 9, 9]


def test_gradients_of_the_network():
    rng = np.random.default_rng(2)
    places = rng.integers(0, 4, (6, 6, 5)).astype(float)
    weights = {k: v.astype(float) for k, v in lm.start(5).items()}
    loss = lambda w: -(places * lm.forward(w)[1]).sum() / places.sum()
    slopes = lm.gradients(weights, places)
    for k, at in (("left", (1, 3)), ("right", (5, 2)), ("out", (2, 4)), ("bias", (4,)), ("out_bias", (0,))):
        moved = {n: v.copy() for n, v in weights.items()}
        moved[k][at] += 1e-6
        assert (loss(moved) - loss(weights)) / 1e-6 == pytest.approx(slopes[k][at], rel=1e-3, abs=1e-7)


def test_likelihood_against_a_plain_version(spark, small):
    """Words, classes and counts from Python's own containers, the network one place at a time."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").toPandas()
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in docs.text]
    counts = Counter(w for t in texts for w in t)
    total = sum(counts.values())
    one = lambda word: piece([word])
    own = sorted((w for w, n in counts.items() if n >= lm.OWN_SHARE * total), key=lambda w: int(one(w).word_hashes[0]))
    kind = {w: own.index(w) if w in own else len(own) + int(lm.endings(one(w))[0]) for w in counts}
    n = len(own) + lm.CLASSES
    sizes = Counter()
    for w, c in counts.items():
        sizes[kind[w]] += c
    places = np.zeros((n + 1, n + 1, n), np.float32)
    for t in texts:
        line = [n, *(kind[w] for w in t), n]
        for a, b, c in zip(line, line[1:], line[2:]):
            places[a, c, b] += 1
    weights = lm.train(places)
    got = QUERIES["op5_score_likelihood"](spark, small).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for doc_id, t in zip(docs.doc_id, texts):
        line, want = [n, *(kind[w] for w in t), n], 0.0
        for a, b, c, w in zip(line, line[1:], line[2:], t):
            logits = np.tanh(weights["left"][a] + weights["right"][c] + weights["bias"]).astype(float) @ weights["out"]
            logits = logits + weights["out_bias"]
            want += logits[b] - np.log(np.exp(logits).sum())
            want += 0.0 if w in own else math.log(counts[w] / sizes[kind[w]])
        assert got.n_tokens[doc_id] == len(t)
        assert got.log_prob[doc_id] == pytest.approx(want, abs=1e-4 * max(len(t), 1))
    alone = sum(c * math.log(c / total) for c in counts.values())
    assert got.log_prob.sum() > alone  # better than the words' frequencies


def test_likelihood_does_not_hang_on_tasks_and_tells_order(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    few = {r.doc_id: r.log_prob for r in lm.scored(docs.repartition(2)).collect()}
    assert few == {r.doc_id: r.log_prob for r in lm.scored(docs.repartition(7, "text")).collect()}
    rng = np.random.default_rng(3)
    mixed = docs.toPandas().dropna()
    mixed["text"] = [" ".join(rng.permutation(t.split())) for t in mixed.text]
    mixed = mixed[mixed.text.str.split().str.len() > 50]
    model = lm.learn(docs)
    worse = lm.score(spark.createDataFrame(mixed), model, ["doc_id"]).collect()
    assert np.mean([few[r.doc_id] > r.log_prob for r in worse]) > 0.9
    unseen = lm.score(spark.createDataFrame([(1, "zzqjx")], "doc_id long, text string"), model).first()
    assert unseen.log_prob < math.log(1e-3)


def test_quality_with_text_ids_and_one_id_on_many_rows(spark):
    good, bad = "a calm sentence with words in it. ", "$$ ## buy buy buy ## $$ "
    rows = [(f"d{i}", (good if i % 2 else bad) * (1 + i % 5)) for i in range(200)] + [("d1", good)] * 3000
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    marks = spark.createDataFrame([(f"d{i}", i % 2) for i in range(200)], "doc_id string, quality int")
    got = fm.score(docs, fm.learn(docs, marks)).groupBy("text").agg({"predicted": "max"}).collect()
    assert all(r[1] == int(good in r.text) for r in got)
