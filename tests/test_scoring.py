import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import as_set, column, frame
from tillwatch.operators import ml, scoring
from tillwatch.plans.queries import QUERIES, NumpyLogit
from tillwatch.sources import artifacts


def test_logistic_and_mean(spark):
    rows = frame(spark, "x double, y int", {"x": 1.0, "y": 2}, {"x": None, "y": None})
    members = [scoring.logistic({"x": 0.5, "y": 1.0}, -1.0), scoring.logistic({}, 0.0)]
    got = column(rows.select(scoring.mean_probability(members).alias("p")), "p")
    assert got == pytest.approx([(1 / (1 + math.exp(-1.5)) + 0.5) / 2, (1 / (1 + math.exp(1.0)) + 0.5) / 2])


def test_decision_is_inclusive_and_gated_by_the_card(spark):
    rows = frame(spark, "p double, card_found boolean", {"p": 0.5, "card_found": True},
                 {"p": 0.4999, "card_found": True}, {"p": 0.9, "card_found": False})
    out = scoring.with_decision(rows, F.col("p")).select("fraud_probability", "predicted_fraud")
    assert [tuple(r) for r in out.collect()] == [(0.5, 1), (0.4999, 0), (None, 0)]


def test_opaque_models_match_their_own_predictions(spark):
    models = [NumpyLogit([0.3, -0.2], 0.1), NumpyLogit([1.0, 0.0], -0.5)]
    values = [(float(i), float(i % 7)) for i in range(50)]
    rows = spark.createDataFrame(values, "a double, b double").repartition(4)
    score = scoring.opaque_ensemble(spark, models, ["a", "b"], preprocess=lambda frame: frame.fillna(0.0))
    got = {(r["a"], r["b"]): r["p"] for r in rows.withColumn("p", score("a", "b")).collect()}
    for a, b in values:
        expected = np.mean([1 / (1 + math.exp(-(a * m.weights[0] + b * m.weights[1] + m.bias))) for m in models])
        assert got[a, b] == pytest.approx(expected)


def test_ml_ensemble_learns_saves_and_loads_once(spark, tmp_path):
    rows = spark.range(400).selectExpr(
        "cast(id % 2 AS int) AS label", "CASE WHEN id % 13 = 0 THEN NULL ELSE cast(id % 2 AS double) * 3 + rand(5) END AS x",
        "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS kind",
    )
    fitted = ml.fit_ensemble(rows, "label", ["x"], ["kind"], trees=3, depth=2)
    path = str(tmp_path / "ensemble")
    fitted.save(path)
    loaded = ml.load_ensemble(spark, path)
    assert ml.load_ensemble(spark, path) is loaded
    scored = loaded.score(rows.filter("x IS NOT NULL"))
    wrong = scoring.with_decision(scored, F.col("fraud_probability")).filter("predicted_fraud <> label").count()
    assert wrong == 0
    before = column(fitted.score(rows.orderBy("x", "kind")), "fraud_probability")
    assert before == pytest.approx(column(loaded.score(rows.orderBy("x", "kind")), "fraud_probability"))


def test_ensemble_takes_thousands_of_categories(spark):
    rows = spark.range(20_000).selectExpr(
        "cast(id % 2 AS int) AS label", "cast(id % 2 AS double) + rand(3) AS x", "concat('c', id % 10000) AS kind")
    fitted = ml.fit_ensemble(rows, "label", ["x"], ["kind"], trees=2, depth=2, max_rows=5_000)
    assert fitted.score(rows).filter("fraud_probability BETWEEN 0 AND 1").count() == 20_000
    bounded = ml._bounded(rows, 5_000).count()
    assert 4_000 < bounded < 6_000 and ml._bounded(rows, 5_000).count() == bounded


def test_models_are_fitted_to_all_rows(spark, small, monkeypatch):
    """Neither the query nor, unless asked, the fit leaves rows out."""
    monkeypatch.setattr(ml, "_bounded", lambda rows, max_rows: rows.limit(0))
    rows = spark.range(300).selectExpr("cast(id % 2 AS int) AS label", "cast(id % 2 AS double) AS x")
    scored = ml.fit_ensemble(rows, "label", ["x"], trees=2, depth=1).score(rows)
    assert scored.filter("(fraud_probability >= 0.5) <> (label = 1)").count() == 0
    asked = []
    fit = ml.fit_ensemble
    monkeypatch.setattr(ml, "fit_ensemble", lambda *a, **b: asked.append(b) or fit(*a, **b, trees=1, depth=1))
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert QUERIES["ml_ensemble_score"](spark, small).count() == lines and asked == [{}]


def test_columns_of_one_value_are_left_out_where_they_tell_nothing(spark, tmp_path):
    rows = spark.range(400).selectExpr(
        "cast(id % 2 AS int) AS label", "cast(id % 2 AS double) + rand(4) AS x", "1.5D AS same",
        "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS kind")
    fitted = ml.fit_ensemble(rows, "label", ["x", "same"], ["kind"], trees=2, depth=2)
    widths = {name: model.stages[0].numFeatures for name, model in fitted.members.items()}
    assert widths == {"boosted": 3, "forest": 258, "linear": 3}
    fitted.save(str(tmp_path / "slim"))
    loaded = ml.load_ensemble(spark, str(tmp_path / "slim"))
    assert as_set(loaded.score(rows)) == as_set(fitted.score(rows))
    flat = rows.select("label", "same")
    assert ml.fit_ensemble(flat, "label", ["same"], trees=1, depth=1).score(flat).filter("fraud_probability > 0").count() == 400


def test_an_ensemble_saved_anew_is_loaded_anew(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id % 2 AS int) AS label", "cast(id AS double) AS x")
    path = str(tmp_path / "model")
    ml.fit_ensemble(rows, "label", ["x"], trees=1, depth=1).save(path)
    first = ml.load_ensemble(spark, path)
    ml.fit_ensemble(rows, "label", ["x"], trees=1, depth=1).save(path)
    assert ml.load_ensemble(spark, path) is not first


def test_artifacts_are_read_as_bytes(spark, tmp_path):
    (tmp_path / "model.bin").write_bytes(b"\x00\x01binary")
    (tmp_path / "names.txt").write_text("a,b")
    assert artifacts.read_artifact(spark, str(tmp_path / "model.bin")) == b"\x00\x01binary"
    assert as_set(artifacts.artifact_listing(spark, str(tmp_path))) == [("model.bin", 8), ("names.txt", 3)]
    with pytest.raises(ValueError):
        artifacts.read_artifact(spark, str(tmp_path))
