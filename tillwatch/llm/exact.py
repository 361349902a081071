"""Exact deduplication by a content sort (operator 13).

Texts are lower-cased (A-Z alone) and sorted over the whole table. Splitters that
Spark samples cut the order into ranges, each range is sorted by its task, which
spills, and equal texts then lie next to each other: every text is compared in
full with the one before it. The order is by the first ``HEAD`` characters, a
hash of the text, the text, and the identifier; splitters are made of all of
these but the text, so they stay narrow, and a group of copies that holds a large
part of the rows is cut between identifiers and shared out.

A run that may go on in a neighbouring range leaves its text once. These few
texts, two for each range, are grouped to join the parts of such groups; nothing
else is shuffled a second time.

Defined cases: a null text counts as empty, and empty texts equal each other;
the largest identifier stays, null being the smallest; of rows that share text
and identifier one stays; identifiers may be of any type that Spark can sort;
an empty table gives an empty one. Input columns with the name of a result
column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tillwatch.llm.shared import ascii_lower, staged, without

HEAD = 32
COLUMNS = ("keep_id", "group_size", "kept", "text_sha256")
KEY = ("_head", "_hash")


def content_sorted(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``docs`` with ``_norm`` and its sort key, in ranges of the content order, each sorted."""
    rows = docs.withColumn("_norm", F.coalesce(ascii_lower(F.col("text")), F.lit("")))
    rows = rows.withColumns({
        "_head": F.substring("_norm", 1, HEAD), "_hash": F.xxhash64("_norm"), "_salt": F.spark_partition_id()})
    last = [F.desc_nulls_last("doc_id"), "_salt"]
    rows = rows.repartitionByRange(*([ranges] if ranges else []), *KEY, *last)
    return rows.sortWithinPartitions(*KEY, "_norm", *last)


def changes(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """For each value whether it differs from the one before it; ``before`` is the one before the first."""
    out = np.ones(len(column), bool)
    if len(column) > 1:
        out[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    if before is not None and len(column):
        out[0] = not column[0].equals(before)
    return out


class Runs:
    """Finds the runs of equal texts in one range, which comes as sorted batches.

    Rows are held until the key of their run is passed, without their texts.
    """

    def __init__(self, part: int, carried: Sequence[str]) -> None:
        self.part, self.carried = part, list(carried)
        self.before: dict[str, pa.Scalar | None] = dict.fromkeys((*KEY, "_norm"))
        self.key = self.run = -1
        self.open: list[pa.Table] = []
        self.first_of_key: list[tuple[int, int, str]] = []  # key, run and text of the runs of the open key

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        columns = {name: batch.column(name) for name in self.before}
        new_key = np.zeros(len(batch), bool)
        for name in KEY:
            new_key |= changes(columns[name], self.before[name])
        new_run = new_key | changes(columns["_norm"], self.before["_norm"])
        keys, runs = self.key + np.cumsum(new_key), self.run + np.cumsum(new_run)
        narrow = pa.table({**{c: batch.column(c) for c in self.carried}, "_key": keys, "_run": runs})
        cut = int(np.flatnonzero(new_key)[-1]) if new_key.any() else 0
        started = np.flatnonzero(new_run)
        texts = [(int(keys[i]), int(runs[i]), columns["_norm"][i].as_py()) for i in started]
        if new_key.any():
            whole = [t for t in texts if t[0] < keys[-1]]
            done = pa.concat_tables([*self.open, narrow[:cut]])
            if len(done):
                yield self.finished(done, self.first_of_key + whole, last=False)
            self.open, self.first_of_key = [], [t for t in texts if t[0] == keys[-1]]
        else:
            self.first_of_key += texts
        self.open.append(narrow[cut:])
        self.key, self.run = int(keys[-1]), int(runs[-1])
        self.before = {name: columns[name][len(batch) - 1] for name in columns}

    def end(self) -> Iterator[pa.Table]:
        if self.open:
            yield self.finished(pa.concat_tables(self.open), self.first_of_key, last=True)

    def finished(self, rows: pa.Table, texts: list[tuple[int, int, str]], last: bool) -> pa.Table:
        """Rows of whole runs with what is known of their group; runs at an end of the range keep their text."""
        runs = rows["_run"].to_numpy()
        _, first, of, counts = np.unique(runs, return_index=True, return_inverse=True, return_counts=True)
        sha = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for _, _, t in texts])
        at_end = np.array([key == 0 or last for key, _, _ in texts])
        is_first = np.zeros(len(runs), bool)
        is_first[first] = True
        text = pa.array([t if e else None for (_, _, t), e in zip(texts, at_end)], pa.string())
        return pa.table({
            **{c: rows[c] for c in self.carried},
            "keep_id": rows["doc_id"].combine_chunks().take(pa.array(first)).take(pa.array(of)),
            "group_size": counts[of],
            "kept": is_first,
            "text_sha256": sha.take(pa.array(of)),
            "_part": pa.array(np.full(len(runs), self.part), pa.int32()),
            "_run": runs,
            "_edge": at_end[of],
            "_text": pc.if_else(pa.array(is_first), text.take(pa.array(of)), pa.scalar(None, pa.string())),
        })


def runs(docs: DataFrame, carried: Sequence[str], ranges: int | None = None) -> DataFrame:
    """A row for each document with its group as far as its own range shows it."""
    id_type = docs.schema["doc_id"].dataType
    schema = StructType([
        *[docs.schema[c] for c in carried],
        StructField("keep_id", id_type), StructField("group_size", LongType()), StructField("kept", BooleanType()),
        StructField("text_sha256", StringType()), StructField("_part", IntegerType()), StructField("_run", LongType()),
        StructField("_edge", BooleanType()), StructField("_text", StringType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Runs(TaskContext.get().partitionId(), carried)
        for batch in batches:
            if len(batch):
                for table in state.add(batch):
                    yield from table.to_batches()
        for table in state.end():
            yield from table.to_batches()

    wanted = list(dict.fromkeys([*carried, "doc_id"]))
    return content_sorted(docs, ranges).select(*wanted, *KEY, "_norm").mapInArrow(find, schema)


def classes(docs: DataFrame, carried: Sequence[str] = ("doc_id",), ranges: int | None = None) -> DataFrame:
    """``carried`` columns of ``docs`` (doc_id, text, ...) with the columns of ``COLUMNS``, a row for every row."""
    docs = without(docs, *COLUMNS)
    wanted = [c for c in docs.columns if c in {*carried, "doc_id", "text"}]
    found = staged(runs(docs.select(*wanted), carried, ranges), "content_runs")
    # One row for each range that the group reaches into: as few as there are ranges.
    group, along = Window.partitionBy("_text"), Window.partitionBy("_text").orderBy("_part")
    parts = found.filter(F.col("_text").isNotNull()).select(
        "_part", "_run", F.sum("group_size").over(group).alias("_size"),
        F.first("keep_id").over(along).alias("_keep"), F.min("_part").over(group).alias("_first_part"))
    # Bounded by the number of ranges: two rows for each, but for texts that share a hash.
    joined = found.join(F.broadcast(parts), ["_part", "_run"], "left")
    edge = F.col("_edge")
    return joined.select(
        *carried,
        F.when(edge, F.col("_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(edge, F.col("_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("kept") & (~edge | (F.col("_part") == F.col("_first_part")))).alias("kept"),
        "text_sha256")


def deduplicated(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest identifier."""
    own = docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c.lower() in COLUMNS})
    kept = classes(own, own.columns, ranges).filter("kept").drop(*COLUMNS)
    return kept.withColumnsRenamed({f"_own_{c}": c for c in docs.columns if c.lower() in COLUMNS})


SQL = r"""
WITH normal AS (
  SELECT doc_id, coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM normal
"""
