"""Corrections of as-of lookups after versions that came late.

A late version is in force from its own time to that of the next version of its
key. Nothing else changes, so only facts in these intervals are looked up again:
they are found by key and time bucket, and placed by an as-of lookup among the
starts of the intervals, so no pairs of facts and intervals are formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillwatch.operators import bloom
from tillwatch.operators.joins import ROWS_PER_TASK, asof_lookup, lookup
from tillwatch.operators.latest import latest_by_key

FROM, TO, BUCKET = "_from", "_to", "_bucket"


def changed_intervals(
    known: DataFrame, late: DataFrame, key: str, version_time: str, tie_break: Sequence[str]
) -> DataFrame:
    """Late versions that are in force at some time, with ``_from`` and ``_to``, which is null where nothing follows.

    Of versions of one key and time the greatest ``tie_break`` is in force, so a
    late one may change nothing. Of the known versions only those of the late
    ones' keys are read, without their values.
    """
    usable = F.col(key).isNotNull() & F.col(version_time).isNotNull()
    late = latest_by_key(late.filter(usable), [key, version_time], tie_break)
    marks = [key, version_time, *tie_break]
    before = lookup(known.filter(usable).select(*marks), late.select(key).distinct(), key, "left_semi")
    times = before.withColumn("_late", F.lit(False)).unionByName(late.select(*marks).withColumn("_late", F.lit(True)))
    # Of equal marks the late one is a repeat.
    first = latest_by_key(times, [key, version_time], [*tie_break, ~F.col("_late")])
    following = F.lead(version_time).over(Window.partitionBy(key).orderBy(version_time))
    ranges = first.select(key, version_time, "_late", following.alias(TO)).filter("_late").drop("_late")
    return late.join(ranges, [key, version_time]).withColumnRenamed(version_time, FROM)


def _spans(changed: DataFrame, key: str, bucket: str, until: DataFrame) -> DataFrame:
    """``touched_buckets``, one of them again for each interval that lies in it."""
    last = F.date_trunc(bucket, until.scalar())
    start = F.date_trunc(bucket, FROM)
    end = F.least(F.coalesce(F.date_trunc(bucket, F.col(TO)), last), last)
    spans = F.when(start <= end, F.sequence(start, end, F.expr(f"interval 1 {bucket}")))
    return changed.select(key, F.explode(spans).alias(BUCKET))


def touched_buckets(changed: DataFrame, key: str, bucket: str, until: DataFrame) -> DataFrame:
    """(key, _bucket): the time buckets that the intervals lie in, up to the newest fact (``until``, one row and column)."""
    return _spans(changed, key, bucket, until).distinct()


def _near(facts: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """``facts`` of the touched buckets, told by a filter and not shuffled for it, so some of other buckets are among them."""
    place = F.xxhash64(key, BUCKET).alias("_place")
    if all(facts.schema[c].dataType == spans.schema[c].dataType for c in (key, BUCKET)):
        usable = facts.filter(F.col(key).isNotNull() & F.col(BUCKET).isNotNull())
        marked = bloom.told(usable.withColumn("_place", place), spans.select(place), "_place", "_place")
        if marked is not None:
            return marked.filter("_maybe").drop("_maybe", "_place")
    return facts.join(spans.distinct(), [key, BUCKET], "left_semi")


def corrections(
    facts: DataFrame, changed: DataFrame, key: str, fact_time: str, bucket: str = "month",
    rows_per_task: int = ROWS_PER_TASK, skew_from: DataFrame | None = None,
) -> DataFrame:
    """``facts`` that lie in a changed interval, with the version now in force.

    Where ``facts`` has a ``_bucket`` column it is taken for the truncated time;
    partition a table by it, and only the partitions of changed buckets are read.
    ``skew_from`` is as in ``lookup``, by default all ``facts``.
    """
    if BUCKET not in facts.columns:
        facts = facts.withColumn(BUCKET, F.date_trunc(bucket, F.col(fact_time)))
    columns = [c for c in facts.columns if c != BUCKET]
    near = _near(facts, _spans(changed, key, bucket, facts.agg(F.max(fact_time))), key).select(*columns)
    # Hot keys are looked for among all facts, which needs no join.
    found = asof_lookup(near, changed, key, fact_time, FROM, [FROM], bucket=bucket, rows_per_task=rows_per_task,
                        skew_from=facts.select(key) if skew_from is None else skew_from)
    return found.filter(F.col(FROM).isNotNull() & (F.col(TO).isNull() | (F.col(fact_time) < F.col(TO)))).drop(TO)


def changed_partitions(changed: DataFrame, key: str, bucket: str, until: DataFrame) -> list:
    """The changed buckets of all keys, to name partitions by; as many as the time that facts cover has buckets."""
    return sorted(r[0] for r in _spans(changed, key, bucket, until).select(BUCKET).distinct().collect())
