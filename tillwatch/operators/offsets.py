"""Lost and repeated offsets: gaps and islands over (partition, offset).

Offsets are cut into blocks, so that a hot partition is shared out. Each block
finds its own gaps and repeats and its first and last offset; the gaps between
blocks follow from one row for each block. Across micro-batches the last offset
of each partition is carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

PARTITION, OFFSET = "kafka_partition", "kafka_offset"
BLOCK = 1_000_000


def faults(messages: DataFrame, carried: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(kafka_partition, fault, first_offset, last_offset): ranges that are missing, or repeated, and as long as can be.

    ``carried`` (kafka_partition, last_offset) is where earlier batches ended; a
    message at or before it is not looked at. Nulls are left out.
    """
    rows = messages.select(PARTITION, OFFSET).filter(f"{PARTITION} IS NOT NULL AND {OFFSET} IS NOT NULL")
    if carried is not None:
        ends = carried.select(PARTITION, F.col("last_offset").alias("_end"))
        rows = rows.join(ends, PARTITION, "left").filter(f"_end IS NULL OR {OFFSET} > _end")
        opening = rows.groupBy(PARTITION).agg(F.max("_end").alias("_end"), F.min(OFFSET).alias("_first")).filter(
            "_first > _end + 1").select(
            PARTITION, (F.col("_end") + 1).alias("first_offset"), (F.col("_first") - 1).alias("last_offset"))
        rows = rows.drop("_end")
    # Repeats are combined before the shuffle, so a message that came very often is one row of each task.
    counted = rows.groupBy(PARTITION, OFFSET).agg(F.count("*").alias("_n")).withColumn(
        "_block", F.floor(F.col(OFFSET) / block))
    within = Window.partitionBy(PARTITION, "_block").orderBy(OFFSET)
    along = Window.partitionBy(PARTITION).orderBy("_block")

    gaps = counted.withColumn("_next", F.lead(OFFSET).over(within)).filter(f"_next > {OFFSET} + 1")
    inner = gaps.select(PARTITION, (F.col(OFFSET) + 1).alias("first_offset"), (F.col("_next") - 1).alias("last_offset"))
    blocks = counted.groupBy(PARTITION, "_block").agg(F.min(OFFSET).alias("_first"), F.max(OFFSET).alias("_last"))
    between = blocks.withColumn("_next", F.lead("_first").over(along)).filter("_next > _last + 1").select(
        PARTITION, (F.col("_last") + 1).alias("first_offset"), (F.col("_next") - 1).alias("last_offset"))
    missing = inner.unionByName(between)
    if carried is not None:
        missing = missing.unionByName(opening)

    island = (F.col(OFFSET) - F.row_number().over(within)).alias("_island")
    islands = counted.filter("_n > 1").select(PARTITION, "_block", OFFSET, island).groupBy(
        PARTITION, "_block", "_island").agg(F.min(OFFSET).alias("_first"), F.max(OFFSET).alias("_last"))
    # Islands that meet at the end of a block are one.
    meets = Window.partitionBy(PARTITION).orderBy("_first")
    at_edge = (F.pmod("_first", F.lit(block)) == 0) | (F.pmod(F.col("_last") + 1, F.lit(block)) == 0)
    starts = (F.coalesce(F.lag("_last").over(meets), F.lit(-2)) != F.col("_first") - 1).cast("int")
    edges = islands.filter(at_edge).withColumn("_start", starts).withColumn(
        "_of", F.sum("_start").over(meets)).groupBy(PARTITION, "_of").agg(
        F.min("_first").alias("first_offset"), F.max("_last").alias("last_offset")).drop("_of")
    inside = islands.filter(~at_edge).select(
        PARTITION, F.col("_first").alias("first_offset"), F.col("_last").alias("last_offset"))
    repeated = edges.unionByName(inside)
    return missing.withColumn("fault", F.lit("missing")).unionByName(repeated.withColumn("fault", F.lit("repeated")))


def ends(messages: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """(kafka_partition, last_offset): what the next batch carries on from."""
    last = messages.filter(f"{PARTITION} IS NOT NULL AND {OFFSET} IS NOT NULL").groupBy(PARTITION).agg(F.max(OFFSET).alias("last_offset"))
    both = last if carried is None else last.unionByName(carried.select(PARTITION, "last_offset"))
    return both.groupBy(PARTITION).agg(F.max("last_offset").alias("last_offset"))
