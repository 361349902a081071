"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillwatch.llm import cascade, decontaminate, fm, jaccard, langid, licenses, lm, mixing, pii, urls

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, size string, "
          "n_words string, n_private string, taken string, kept string, labels string, host string, `pass` string")
LONG = " ".join(f"word{i % 97} item{i % 31}" for i in range(30_000))
SAME = "one row that is here two times and has more than ten words in it"


def rows():
    plain = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t \x0b", "en", "a", 4),
        (4, LONG, "en", "a", len(LONG)),
        (5, SAME, "en", "b", len(SAME)),
        (5, SAME, "en", "b", len(SAME)),
        (None, "a row without an id that has a few words of its own to tell", "en", "b", 10),
        (7, "12345 !!! 999", None, None, 9),
        (8, "x", "de", "", 1),
    ]
    return [(*r, *["mine"] * 9) for r in plain]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 0, 0), (None, 1, 0), (2, None, None)],
                                 "doc_id long, quality long, toxic long")


ROW_OPERATORS = {
    "pii": pii.pseudonymise,
    "langid": lambda d: langid.predict(d, langid.learn(d)),
    "mixing": mixing.mix,
    "lm": lm.scored,
    "cascade": cascade.judge,
    "licenses": licenses.scan,
    "urls": lambda d: urls.judge(d.withColumn("url", F.concat(F.lit("http://a.example.com/en/"), "text"))),
}


@pytest.mark.parametrize("name", sorted(ROW_OPERATORS))
def test_a_row_for_every_row(odd, none, name):
    out = ROW_OPERATORS[name](odd)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(map(str, (r[0] for r in rows())))
    empty = ROW_OPERATORS[name](none)
    assert empty.columns == out.columns and empty.count() == 0


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_values_of_odd_texts(odd):
    got = by_id(langid.predict(odd, langid.learn(odd)))
    assert [got[i].lang_pred for i in (1, 2, 3, 7)] == ["und"] * 4 and got[7].score == 0.0
    assert got[4].lang_pred == "en" and 0 <= got[4].score <= 1
    got = by_id(cascade.judge(odd))
    assert got[1].base_failed and got[2].n_words == 0 and not got[1].kept
    assert got[4].n_words == 60_000 and got[4].base_failed  # words come round again
    assert got[5].kept and got[5].n_words == 15
    got = by_id(licenses.scan(odd))
    assert got[1].n_words == 0 and got[1].labels == "" and got[1].score == 0.0 and got[1].first_word is None
    got = by_id(pii.pseudonymise(odd))
    assert got[1].text is None and got[2].text == "" and got[4].text == LONG and got[4].n_private == 0
    got = by_id(lm.scored(odd))
    assert got[1].n_tokens == 0 and got[1].mean_log_prob is None and got[1].log_prob == 0.0
    assert got[8].n_tokens == 1 and got[8].log_prob < 0 and got[4].n_tokens == 60_000


def test_quality_of_odd_texts(odd, none, labels):
    machine = fm.learn(odd, labels)
    got = fm.score(odd, machine)
    assert got.count() == 9 and got.filter("score BETWEEN 0 AND 1 AND predicted IN (0, 1)").count() == 9
    assert got.filter("(score >= 0.7) != (predicted = 1)").count() == 0
    untrained = fm.learn(none, labels.limit(0))
    assert {r.score for r in fm.score(odd, untrained).collect()} == {0.5}
    assert fm.score(none, machine).count() == 0


def test_mix_of_odd_texts(odd):
    got = mixing.mix(odd).collect()
    of = {r.doc_id: r for r in got}
    assert of[1].taken == 0 and of[2].taken == 0 and of[1].source_size == 3  # with the other null source
    assert all(r.taken <= 2 * r.size for r in got)
    copies = mixing.repeated(mixing.mix(odd))
    assert copies.agg(F.sum("size")).first()[0] == sum(r.taken for r in got)


def test_near_copies_of_odd_texts(odd, none):
    got = sorted(map(tuple, jaccard.classes(odd).collect()), key=str)
    of = {r[0]: r for r in got}
    assert len(got) == 9 and of[1] == (1, 1, 0, 0) and of[3] == (3, 3, 0, 0)
    assert of[5] == (5, 5, 1, 11) and of[8] == (8, 8, 0, 1) and of[None][1:3] == (None, 0)
    kept = jaccard.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == 8
    assert jaccard.classes(none).count() == 0 and jaccard.deduplicated(none).count() == 0


def test_leaks_of_odd_texts(spark, odd, none):
    bench = spark.createDataFrame(
        [(1, SAME), (2, SAME), (3, None), (4, ""), (5, "too short"), (None, "a row without an id that has a few words")],
        "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, bench).collect()}
    assert got == {(5, 1), (5, 2), (None, None)}
    assert sorted(str(r.doc_id) for r in decontaminate.clean(odd, bench).collect()) == ["1", "2", "3", "4", "7", "8"]
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0


def test_stages_keep_the_columns(spark, small, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
            assert docs.columns == odd.columns, name
        assert set(odd.columns) <= set(corpus_pipeline.STAGES[-1][1](spark, docs, small).columns)
    first = corpus_pipeline.STAGES[0][1](spark, odd, small)
    assert {r.score for r in first.collect()} == {"mine"}
    assert sorted(str(r.doc_id) for r in first.collect()) == ["4", "5", "5", "8", "None"]
