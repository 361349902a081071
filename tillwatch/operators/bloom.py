"""Orphans by a Bloom filter over the keys of an entity.

The filter is in blocks of 64 bits: a key's hash names a block and four bits of
it. Blocks are made by the tasks that read the keys, are combined by ``bit_or``,
and are broadcast; the number of them follows from an exact count of keys. Rows
that the filter does not know are orphans and are shuffled no more; only the
others are joined with the keys. There are ``MOST_BLOCKS`` blocks at most: more
keys fill them further, which tells fewer rows, and keys that would fill them
(``MOST_KEYS_IN_BLOCK``: a sixth of the other rows pass) are joined at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.operators.joins import lookup

KEYS_IN_BLOCK = 4
MOST_KEYS_IN_BLOCK = 16
BITS = 4
MOST_BLOCKS = 4_000_000  # 16 bytes each


def block_and_bits(key: Column, blocks: int) -> tuple[Column, Column]:
    """The block of a key and its bits in it, from two hashes."""
    block = F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).alias("_block")
    hashed = F.xxhash64(F.lit("bits"), key)
    places = [F.pmod(F.shiftrightunsigned(hashed, 6 * i), F.lit(64)).cast("int") for i in range(BITS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return block, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("_bits")


def key_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _bits) of the keys, at most one row for each block."""
    return keys.select(*block_and_bits(F.col(key), blocks)).groupBy("_block").agg(F.bit_or("_bits").alias("_bits"))


def told(facts: DataFrame, keys: DataFrame, fact_key: str, table_key: str) -> DataFrame | None:
    """``facts`` with ``_maybe``, whether the filter knows their key; None if the keys are too many for one."""
    n = keys.count()
    if n > MOST_BLOCKS * MOST_KEYS_IN_BLOCK:
        return None
    blocks = min(max(1, n // KEYS_IN_BLOCK), MOST_BLOCKS)
    block, bits = block_and_bits(F.col(fact_key), blocks)
    made = key_filter(keys, table_key, blocks).withColumnRenamed("_bits", "_of_keys")
    marked = facts.withColumns({"_block": block, "_bits": bits}).join(F.broadcast(made), "_block", "left")
    known = F.col("_of_keys").bitwiseAND(F.col("_bits")) == F.col("_bits")
    maybe = F.coalesce(known, F.lit(False)) & F.col(fact_key).isNotNull()
    return marked.withColumn("_maybe", maybe).drop("_block", "_bits", "_of_keys")


def orphans(facts: DataFrame, table: DataFrame, fact_key: str, table_key: str) -> DataFrame:
    """Rows of ``facts`` whose key is not in the table, null keys among them."""
    keys = table.select(F.col(table_key).alias(fact_key)).filter(F.col(fact_key).isNotNull()).distinct()
    marked = told(facts, keys, fact_key, fact_key)
    if marked is None:
        return lookup(facts, keys, fact_key, "left_anti")
    sure = marked.filter(~F.col("_maybe")).drop("_maybe")
    return sure.unionByName(lookup(marked.filter("_maybe").drop("_maybe"), keys, fact_key, "left_anti").select(*sure.columns))
