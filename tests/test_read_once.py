"""What is read more than once is written first, and messages go to files of bounded size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import as_set, frame
from tillwatch.operators import cutoff, joins
from tillwatch.operators.joins import asof_lookup
from tillwatch.plans import live
from tillwatch.plans.queries import QUERIES
from tillwatch.sources import workspace


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["panel_amount", "retention_batches", "trailing_batches"])
def test_views_read_points_and_not_the_lines_again(spark, small, name):
    assert "l_orderkey" not in plan(QUERIES[name](spark, small))


def test_labelled_rows_are_read_once(spark):
    rows = spark.range(1000).selectExpr("(id % 7) / 7.0D AS score", "cast(id % 3 = 0 AS int) AS label")
    found = cutoff.auc_and_cutoff(rows, "score", "label")
    assert "Range (" not in plan(found) and found.first()["auc"] == pytest.approx(0.5, abs=0.01)


def test_files_of_messages_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(live, "MESSAGES_IN_FILE", 10)
    assert [live._files(spark.range(n)) for n in (0, 1, 10, 11, 95)] == [1, 1, 1, 2, 10]
    assert [live._files(spark.range(n), 3) for n in (0, 30, 31, 95)] == [3, 3, 6, 12]


def test_more_files_give_the_same_counters(spark, small, monkeypatch):
    expected = as_set(QUERIES["counters_after_failure"](spark, small))
    monkeypatch.setattr(live, "MESSAGES_IN_FILE", 40)
    assert expected and as_set(QUERIES["counters_after_failure"](spark, small)) == expected


def test_lines_are_joined_with_orders_once_for_the_split_lookup(spark, small):
    assert "l_orderkey" not in plan(QUERIES["asof_enrich_split"](spark, small))


@pytest.mark.parametrize("key_type, time_type", [("string", "timestamp_ntz"), ("int", "timestamp_ntz"), ("string", "timestamp")])
def test_timeline_carries_a_key_and_time_once_and_keeps_their_types(spark, key_type, time_type):
    at = [dt.datetime(2024, 1, 1, h) for h in range(6)]
    facts = spark.createDataFrame([("1", at[3], "x"), ("1", at[0], "y"), (None, at[2], "z"), ("2", None, "w")],
                                  "k string, t timestamp_ntz, id string")
    versions = spark.createDataFrame([("1", at[1], "a"), ("1", at[2], "b"), ("2", at[1], "c")], "k string, s timestamp_ntz, v string")
    versions = versions.select(F.col("k").cast(key_type), F.col("s").cast(time_type), "v")
    found = asof_lookup(facts.select(F.col("k").cast(key_type), "t", "id"), versions, "k", "t", "s", ["v"])
    assert found.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert as_set(found.select("id", "t", "v")) == as_set(frame(
        spark, "id string, t timestamp_ntz, v string", {"id": "x", "t": at[3], "v": "b"}, {"id": "y", "t": at[0]},
        {"id": "z", "t": at[2]}, {"id": "w"}))
    if time_type == "timestamp_ntz":
        assert "struct(id" in plan(found)


def test_lines_that_need_no_correction_are_told_by_a_filter(spark, small):
    assert "_block" in plan(QUERIES["asof_corrected"](spark, small))


def test_models_read_written_features(spark, small):
    assert "l_orderkey" not in plan(QUERIES["ml_ensemble_score"](spark, small))


def test_timelines_of_large_inputs_are_sorted_by_as_many_tasks_as_fit(spark, tmp_path, monkeypatch):
    at = [dt.datetime(2024, 1, 1, h) for h in range(24)]
    rows = [(str(i % 7), at[i % 24], i) for i in range(500)]
    spark.createDataFrame(rows, "k string, t timestamp_ntz, n int").write.parquet(str(tmp_path / "facts"))
    spark.createDataFrame([(str(i % 9), at[i % 20], i) for i in range(60)], "k string, s timestamp_ntz, v int").write.parquet(
        str(tmp_path / "versions"))
    facts, versions = spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "versions"))
    usual = asof_lookup(facts, versions, "k", "t", "s", ["v"])
    assert joins.sorted_tasks(facts, versions) is None and "REPARTITION_BY_NUM" not in plan(usual) and "_salt" not in plan(usual)
    size = joins._input_bytes(facts) + joins._input_bytes(versions)
    monkeypatch.setattr(joins, "FEW_BYTES", size)
    monkeypatch.setattr(joins, "SORTED_BYTES", size // 13 + 1)
    assert joins.sorted_tasks(facts, versions) == 13
    assert joins.sorted_tasks(spark.createDataFrame([("1",)], "k string")) is None  # of no known size
    many = asof_lookup(facts, versions, "k", "t", "s", ["v"])
    assert "hashpartitioning(k" in plan(many) and ", 13), REPARTITION_BY_NUM" in plan(many)
    assert as_set(many) == as_set(usual)
    assert as_set(asof_lookup(facts, versions, "k", "t", "s", ["v"], rows_per_task=20)) == as_set(usual)


def test_settings_of_a_query_hold_within_it_alone(spark):
    names = [workspace.CLEANUP, workspace.TASK_BYTES]
    before = [spark.conf.get(name, None) for name in names]
    with pytest.raises(ValueError), workspace.shuffles_dropped(spark), workspace.tasks_of(spark, 1000):
        assert [spark.conf.get(name) for name in names] == ["true", "1000"]
        with workspace.tasks_of(spark, 2000):
            assert spark.conf.get(workspace.TASK_BYTES) == "1000"
        raise ValueError
    assert [spark.conf.get(name, None) for name in names] == before


def test_keys_are_counted_only_where_a_hash_of_them_has_many_rows(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 10 = 0 THEN 'hot' WHEN id % 10 < 3 THEN NULL ELSE cast(id AS string) END AS k")
    assert sorted(joins.hot_keys(rows, "k", 250), key=repr) == [("hot", 2), (None, 3)]
    monkeypatch.setattr(joins, "KEY_HASHES", 1)
    assert sorted(joins.hot_keys(rows, "k", 250), key=repr) == [("hot", 2), (None, 3)]
    monkeypatch.setattr(joins, "KEY_HASHES", 4096)
    grouped, whole = [], type(rows).groupBy
    monkeypatch.setattr(type(rows), "groupBy", lambda self, *by: grouped.append(by) or whole(self, *by))
    assert joins.hot_keys(rows, "k", 1000) == [] and len(grouped) == 1
