"""Aggregates of time series over any range, from nodes at powers of two.

A node of level n holds what is needed of 2^n units of time. Any range is the
union of two nodes of each level at most, so it is read from a number of nodes
that grows with the logarithm of its length, and never from the points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LEVELS = 24  # a node of the last level holds about six months of seconds


def _merged() -> list[Column]:
    return [
        F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.max("max").alias("max"),
        F.max_by("last", "last_unit").alias("last"), F.max("last_unit").alias("last_unit"),
    ]


def unit_of(ts: str) -> Column:
    """Seconds since 1970."""
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def nodes(points: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Nodes (series, level, slot, n, sum, max, last, last_unit) of points (series, ts, value).

    Points are summed to units first, so that what is spread over the levels is as
    long as time, and is combined again before it is shuffled. Nulls count for
    nothing. ``last`` is that of the last unit, the greatest value of points of one time.
    """
    known = points.filter(F.col("value").isNotNull() & F.col("ts").isNotNull())
    units = known.groupBy("series", unit_of("ts").alias("last_unit")).agg(
        F.count("*").alias("n"), F.sum("value").alias("sum"), F.max("value").alias("max"),
        F.max_by("value", F.struct("ts", "value")).alias("last"))
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    spread = units.select("*", level).withColumn("slot", F.expr("shiftright(last_unit, level)"))
    return spread.groupBy("series", "level", "slot").agg(*_merged())


def covering(ranges: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``ranges`` (..., _from, _to in units, the end not included) with ``level`` and ``slot`` of the nodes that cover them.

    Beyond the last level there are as many nodes of it as are needed.
    """
    low, high = F.col("_low"), F.col("_high")
    size = F.expr("shiftleft(1L, level)")
    placed = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumns({
        "_low": F.ceil(F.col("_from") / size), "_high": F.floor(F.col("_to") / size)})
    top = F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    ends = F.filter(
        F.array(F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), low),
                F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), high - 1)), lambda slot: slot.isNotNull())
    slots = F.when(F.col("level") == levels, top).otherwise(F.array_distinct(ends))
    return placed.withColumn("slot", F.explode(slots)).drop("_low", "_high")


def over_ranges(stored: DataFrame, ranges: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``ranges`` (range_id, series, _from, _to) with n, sum, max and last; ranges without a point give no row."""
    found = covering(ranges, levels).join(stored, ["series", "level", "slot"])
    return found.groupBy("range_id", "series").agg(*_merged()).drop("last_unit")
