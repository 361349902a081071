"""Lookup joins from a large fact side into keyed tables.

How a lookup is carried out is left to Spark, which broadcasts what it knows or
at run time finds to be small. Where the lookup table is not known to be small,
keys that hold too many fact rows are salted: their fact rows are spread over
several tasks and their single lookup row is copied to each of them. The salt
only moves rows; the joined rows are the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillwatch.operators.latest import latest_by_key
from tillwatch.sources.static import local_table

ROWS_PER_TASK = 5_000_000
KEY_HASHES = 4096
SORTED_BYTES = 4 * 2**20  # of files, whose rows one task of a timeline sorts in memory
FEW_BYTES = 64 * 2**20  # Spark's own choice of tasks is left for inputs of less
MOST_TASKS = 10_000
UNKNOWN_BYTES = 2**62  # Spark gives more than this for inputs whose size it does not know


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a DataFrame."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 switches broadcasting off."""
    threshold = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(threshold))


def _input_bytes(df: DataFrame) -> int:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def sorted_tasks(*inputs: DataFrame) -> int | None:
    """How many tasks sort what is read for ``inputs`` without spilling; None where that is little or not known. No job is run."""
    size = sum(_input_bytes(df) for df in inputs)
    return min(math.ceil(size / SORTED_BYTES), MOST_TASKS) if FEW_BYTES <= size < UNKNOWN_BYTES else None


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether a lookup table is small enough that no keys need salting; no job is run.

    The optimizer's estimate decides if it is small. With joins inside it is the
    product of their sides and says little; then the inputs together decide. Nothing
    is broadcast on the strength of this: Spark measures the table at run time.
    """
    limit = broadcast_limit(df) if limit is None else limit
    return limit >= 0 and (plan_bytes(df) <= limit or _input_bytes(df) <= limit)


def shuffled_unless_small(table: DataFrame, limit: int | None = None) -> DataFrame:
    """``table`` with a hint to shuffle it, unless its whole input is within the limit for broadcasts.

    Spark goes by the share that the columns read have of the compressed files. Of
    many narrow rows that is a small part of what a broadcast holds in memory.
    """
    limit = broadcast_limit(table) if limit is None else limit
    return table if _input_bytes(table) <= limit else table.hint("merge")


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> list[tuple]:
    """``(key, copies)`` of keys with more rows than one task should hold, null included.

    Only the key column is read. Rows are counted by a hash of the key first, which
    shuffles next to nothing, and then by key where a hash has so many. The counts
    are exact, so every such key is found; there are at most as many as
    ``rows_per_task`` fits into the number of rows.
    """
    hashed = F.pmod(F.xxhash64(key), F.lit(KEY_HASHES))
    crowded = df.groupBy(hashed.alias("_hash")).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task).collect()
    if not crowded:
        return []
    df = df.filter(hashed.isin([row["_hash"] for row in crowded]))
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task)
    return [(row["_key"], math.ceil(row["_n"] / rows_per_task)) for row in counts.collect()]


def _hot_table(df: DataFrame, key: str, hot: list[tuple]) -> DataFrame:
    """The hot keys as a broadcast table; ``hot_keys`` bounds its length."""
    schema = StructType([df.schema[key], StructField("_copies", IntegerType())])
    rows = [(item, copies) for item, copies in hot if item is not None]
    return F.broadcast(local_table(df.sparkSession, rows, schema))


def _spread(df: DataFrame, key: str, hot: list[tuple], by: Sequence[str]) -> DataFrame:
    """Fact side: a salt in ``0 .. copies - 1`` for rows of hot keys, 0 for the others.

    The salt is a hash, hence the same when a lost task is run again. The input
    partition is part of it, so identical copies of a row are spread as well.
    Null keys match nothing, so they may be spread without any copies.
    """
    null_copies = max([copies for item, copies in hot if item is None], default=1)
    copies = F.when(F.col(key).isNull(), F.lit(null_copies)).otherwise(F.coalesce(F.col("_copies"), F.lit(1)))
    salt = F.pmod(F.xxhash64(*by, F.spark_partition_id()), copies).cast("int")
    return (
        df.join(_hot_table(df, key, hot), key, "left")
        .withColumn("_salt", F.when(copies == 1, F.lit(0)).otherwise(salt))
        .drop("_copies")
    )


def _replicate(df: DataFrame, key: str, hot: list[tuple]) -> DataFrame:
    """Lookup side: one copy per salt for hot keys, a single copy for the others."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)) - 1)
    return df.join(_hot_table(df, key, hot), key, "left").withColumn("_salt", F.explode(salts)).drop("_copies")


def lookup(
    fact: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    skew_from: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    limit: int | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``fact`` with ``table``, which has one row per ``key``.

    ``limit`` is the size in bytes up to which a table counts as small, by default
    Spark's own for broadcasts; below 0 both sides are shuffled in any case.
    ``skew_from`` is a cheaper DataFrame with the same ``key`` distribution (say,
    the table the fact was derived from) to look for hot keys in. ``spread_by``
    are the columns salts are hashed from, by default all; a salt keeps its
    columns from being pruned, so name varied ones that are read anyway.
    """
    if fits_broadcast(table, limit):
        return fact.join(table, key, how)
    shuffled = limit is not None and limit < 0
    hot = hot_keys(fact if skew_from is None else skew_from, key, rows_per_task)
    keys = [key, "_salt"] if hot else [key]
    if hot:
        fact, table = _spread(fact, key, hot, spread_by or fact.columns), _replicate(table, key, hot)
    return fact.join(table.hint("merge") if shuffled else table, keys, how).drop("_salt")


def _marked(df: DataFrame, key: str, hot: list[tuple]) -> DataFrame:
    """Add ``_hot``, whether the row's key is one of the hot keys."""
    if not hot:
        return df.withColumn("_hot", F.lit(False))
    null_is_hot = any(item is None for item, _ in hot)
    flag = F.when(F.col(key).isNull(), F.lit(null_is_hot)).otherwise(F.col("_copies").isNotNull())
    return df.join(_hot_table(df, key, hot), key, "left").withColumn("_hot", flag).drop("_copies")


def _opening_versions(facts: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """For each (key, bucket) with facts, the last version of an earlier bucket.

    Works on one row per key and bucket: markers of buckets with facts (0) and
    closing versions of buckets (1). A marker comes before the closing version of
    its own bucket and so sees earlier ones only.
    """
    closing = latest_by_key(known, [key, "_bucket"], ["_time"]).select(
        key, "_bucket", "_version", F.lit(1).alias("_kind")
    )
    version_type = known.schema["_version"].dataType
    markers = facts.select(key, "_bucket").distinct().select(
        key, "_bucket", F.lit(None).cast(version_type).alias("_version"), F.lit(0).alias("_kind")
    )
    carried = F.expr(
        f"last(_version, true) over (partition by `{key}` order by _bucket, _kind "
        "rows between unbounded preceding and current row)"
    )
    found = markers.unionByName(closing).withColumn("_version", carried)
    no_time = F.lit(None).cast(known.schema["_time"].dataType)
    return found.filter((F.col("_kind") == 0) & F.col("_version").isNotNull()).select(
        key, "_bucket", no_time.alias("_time"), "_version"
    )


def asof_lookup(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    fact_time: str,
    version_time: str,
    tie_break: Sequence[str],
    bucket: str = "day",
    skew_from: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join to the version in force at the fact's time: greatest ``version_time <= fact_time``.

    Facts and versions of a key are put on one timeline and each fact takes the
    version last seen; no pairs of facts and versions are formed. For a hot key,
    be it hot among facts or among versions, the timeline is cut into time
    buckets, each opened by the last version from before it, and a bucket with
    too many facts is salted with its versions copied. So no task has to hold
    the whole history of such a key. ``skew_from`` is as in ``lookup``. Tasks are
    as many as the input needs for each to sort its part in memory.
    """
    version_columns = [c for c in versions.columns if c != key]
    hot = {item: copies for item, copies in hot_keys(versions, key, rows_per_task)}
    hot |= dict(hot_keys(fact if skew_from is None else skew_from, key, rows_per_task))
    hot = list(hot.items())

    def bucketed(df: DataFrame, time: str) -> DataFrame:
        return _marked(df, key, hot).withColumn("_bucket", F.when(F.col("_hot"), F.date_trunc(bucket, F.col(time))))

    usable = versions.filter(F.col(key).isNotNull() & F.col(version_time).isNotNull())
    known = bucketed(latest_by_key(usable, [key, version_time], tie_break), version_time).select(
        key, "_hot", "_bucket", F.col(version_time).alias("_time"), F.struct(*version_columns).alias("_version")
    )
    facts = bucketed(fact, fact_time)
    group = F.xxhash64(key, "_bucket").alias("_group")
    if hot:
        hot_facts = facts.filter("_hot")
        opening = _opening_versions(hot_facts, known.filter("_hot"), key)
        entries = known.drop("_hot").unionByName(opening).select("*", group)
        facts = facts.select("*", group)
        crowded = hot_keys(hot_facts.select(group), "_group", rows_per_task)
        facts, entries = _spread(facts, "_group", crowded, fact.columns), _replicate(entries, "_group", crowded)
    else:
        entries = known

    place = [key, "_bucket", "_salt"] if hot else [key]
    # Key and time of a fact are on the timeline already, unless those of the versions are of another type.
    told = {}
    if fact.schema[key].dataType == versions.schema[key].dataType:
        told[key] = F.col(key)
    if fact_time != key and fact.schema[fact_time].dataType == versions.schema[version_time].dataType:
        told[fact_time] = F.col("_time").alias(fact_time)
    rest = [c for c in fact.columns if c not in told]
    timeline = entries.select(*place, "_time", "_version", F.lit(0).alias("_kind")).unionByName(
        facts.select(
            *place, F.col(fact_time).alias("_time"), (F.struct(*rest) if rest else F.lit(1)).alias("_fact"),
            F.lit(1).alias("_kind")
        ),
        allowMissingColumns=True,
    )
    tasks = sorted_tasks(fact, versions)
    if tasks:
        timeline = timeline.repartition(tasks, *place)
    within = ", ".join(f"`{c}`" for c in place)
    in_force = F.expr(
        f"last(_version, true) over (partition by {within} "
        "order by _time nulls first, _kind rows between unbounded preceding and current row)"
    )
    return (
        timeline.withColumn("_version", in_force)
        .filter(F.col("_kind") == 1)
        .select(*[told.get(c, F.col(f"_fact.`{c}`")) for c in fact.columns], *[F.col(f"_version.{c}").alias(c) for c in version_columns])
    )
