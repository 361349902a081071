"""Ranked lexical search by MaxScore with bounds of term pairs (operator 11).

The best documents for each of many queries, by integer BM25 scores. Documents
are indexed in blocks: one row of the index is the inverted lists of a block, for
the terms of the queries. For each block and query the lists are summed up
beforehand: the greatest impact of each term, and, from the intersection of the
lists of two terms that are neighbours in the order of the query, the greatest
impact of both together.

A query reads a block from its terms of high weight down. Terms that cannot lift
a document to the score of the present k-th best, even together, are read only
for documents found already, which drop out as soon as what is left to add is too
little. What several terms can add together is the least sum over all ways to
split them into single terms and neighbouring pairs: a pair adds no more than the
greatest of its two maxima and its joint maximum, which is often far below their
sum. A block whose terms cannot reach the score together is skipped.

The first thresholds come from a search of a few blocks; any documents give lower
bounds, so results are whole. Each task raises them further as it goes. Queries
are read to the driver ``QUERIES_AT_ONCE`` at a time, and with them go only counts
of their own terms; blocks never do.

Defined cases: null and empty texts have no terms and are in no result, nor are
documents whose score is 0; equal scores are in order of identifier, null last;
each row of a table is a document or a query of its own, whatever its
identifier; texts are read whole; empty tables give an empty result. Other columns
are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tillwatch.llm.shared import staged

TOP = 20
BLOCK_DOCUMENTS = 4096
BLOCK_POSTINGS = 1 << 19
FIRST_BLOCKS = 16
QUERIES_AT_ONCE = 1000
PAIRS_AT_ONCE = 256
SHARES = 32  # in which the tasks' results are merged first

# Bytes of a term, A-Z in lower case; all others part terms.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def weight(n_documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * frequency + 1)))


def impacts(weights: np.ndarray, counts: np.ndarray, sizes: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What a term that occurs ``counts`` times adds to the score of a document of ``sizes`` terms."""
    norms = 75 + (25 * sizes * n_documents) // n_terms
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 12 * norms))


# ------------------------------------------------------------------- the index
@dataclass
class Block:
    """Inverted lists of some documents: list i has the documents ``starts[i]`` to ``starts[i + 1]`` of ``places``."""

    ids: pa.Array
    sizes: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    counts: np.ndarray

    @classmethod
    def of_row(cls, batch: pa.RecordBatch, row: int) -> Block:
        values = {name: batch.column(name)[row].values for name in ("ids", "sizes", "terms", "starts", "places", "counts")}
        ids = values.pop("ids")
        return cls(ids, **{name: v.to_numpy().astype(np.int64) for name, v in values.items()})


def index_schema(id_field: StructField) -> StructType:
    numbers = [StructField(n, ArrayType(IntegerType())) for n in ("sizes", "terms", "starts", "places", "counts")]
    return StructType([StructField("ids", ArrayType(id_field.dataType)), *numbers])


def indexed(docs: DataFrame, vocabulary: Sequence[bytes]) -> DataFrame:
    """``docs`` (doc_id, text) as blocks; those without any term are left out, and only terms of the vocabulary are in."""
    numbers = docs.sparkSession.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})
    schema = index_schema(docs.schema["doc_id"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = numbers.value
        ids, sizes, found = [], [], []  # found: (term, place, count)

        def block() -> pa.RecordBatch:
            table = np.array(found, np.int64).reshape(-1, 3)
            table = table[np.lexsort((table[:, 1], table[:, 0]))]
            names, starts = np.unique(table[:, 0], return_index=True)
            columns = [sizes, names, np.append(starts, len(table)), table[:, 1], table[:, 2]]
            lists = [pa.array([np.asarray(c, np.int32)], pa.list_(pa.int32())) for c in columns]
            offsets = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, pa.concat_arrays(ids_arrays())), *lists], names=schema.fieldNames())

        def ids_arrays() -> list[pa.Array]:
            return [pa.array([i.as_py() for i in ids], ids[0].type)]

        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                for word, count in Counter(words).items():
                    number = number_of.get(word)
                    if number is not None:
                        found.append((number, len(ids), count))
                ids.append(doc)
                sizes.append(len(words))
                if len(ids) >= BLOCK_DOCUMENTS or len(found) >= BLOCK_POSTINGS:
                    yield block()
                    ids, sizes, found = [], [], []
        if ids:
            yield block()

    return docs.select("doc_id", "text").mapInArrow(build, schema)


def frequencies(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents, terms in all of them, and documents of each vocabulary term, which are as many as the queries have."""
    total = index.agg(
        F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)).alias("l")
    ).first()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[int] = Counter()
        for batch in batches:
            for row in range(len(batch)):
                block = Block.of_row(batch, row)
                held.update(dict(zip(block.terms.tolist(), np.diff(block.starts).tolist())))
        if held:
            yield pa.RecordBatch.from_pydict({"term": list(held), "n": list(held.values())})

    counted = index.select(*index.columns).mapInArrow(count, "term long, n long")
    return total.n or 0, total.l or 0, {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


@dataclass
class Query:
    """Terms of a query in the order of what they can add, the least first; ``offset`` is where its bounds begin."""

    terms: np.ndarray
    times: np.ndarray
    offset: int


@dataclass
class Plan:
    queries: list[Query]
    weights: np.ndarray  # of the vocabulary
    n_documents: int
    n_terms: int

    def impacts_of(self, block: Block) -> np.ndarray:
        lengths = np.diff(block.starts)
        return impacts(np.repeat(self.weights[block.terms], lengths), block.counts, block.sizes[block.places],
                       self.n_documents, self.n_terms)


def plan_of(texts: Sequence[str | None], number_of: dict[bytes, int], n: int, length: int, df: dict[int, int]) -> Plan:
    weights = np.array([weight(n, df.get(i, 0)) for i in range(len(number_of))], np.int64)
    queries, offset = [], 0
    for text in texts:
        # A term that no document has adds nothing.
        times = {number_of[t]: c for t, c in Counter(terms(text)).items() if df.get(number_of[t])}
        order = sorted(times, key=lambda t: (times[t] * weights[t], t))
        queries.append(Query(np.array(order, np.int64), np.array([times[t] for t in order], np.int64), offset))
        offset += len(order)
    return Plan(queries, weights, n, length)


def lists_of(block: Block, query: Query) -> list[tuple[int, int]]:
    """Bounds of the query's lists in the block; (0, 0) for terms that it does not have."""
    at = np.searchsorted(block.terms, query.terms)
    at[at == len(block.terms)] = 0
    there = block.terms[at] == query.terms if len(block.terms) else np.zeros(len(at), bool)
    starts = np.where(there, block.starts[:-1][at] if len(block.terms) else 0, 0)
    ends = np.where(there, block.starts[1:][at] if len(block.terms) else 0, 0)
    return list(zip(starts.tolist(), ends.tolist()))


def greatest(block: Block, query: Query, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greatest impact of each term, and greatest joint impact of it and the term before it where both occur."""
    n = len(query.terms)
    single, joint = np.zeros(n, np.int64), np.zeros(n, np.int64)
    lists = lists_of(block, query)
    width = len(block.sizes)
    for low in range(0, n, PAIRS_AT_ONCE):
        high = min(n, low + PAIRS_AT_ONCE)
        first = max(low - 1, 0)
        dense = np.zeros((high - first, width), np.int64)
        for row, (start, end) in enumerate(lists[first:high]):
            dense[row, block.places[start:end]] = impact[start:end] * query.times[first + row]
        single[first:high] = dense.max(axis=1)
        both = np.where((dense[1:] > 0) & (dense[:-1] > 0), dense[1:] + dense[:-1], 0)
        joint[first + 1:high] = both.max(axis=1)
    return single, joint


def with_bounds(index: DataFrame, plan: Plan) -> DataFrame:
    """The index with ``single`` and ``joint``: the maxima of all queries, one after the other."""
    shipped = index.sparkSession.sparkContext.broadcast(plan)
    schema = StructType([*index.schema.fields, StructField("single", ArrayType(LongType())),
                         StructField("joint", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shipped.value
        for batch in batches:
            for row in range(len(batch)):
                block = Block.of_row(batch, row)
                impact = plan.impacts_of(block)
                both = [greatest(block, query, impact) for query in plan.queries]
                lists = [pa.array([np.concatenate([np.empty(0, np.int64), *[b[side] for b in both]])], pa.list_(pa.int64()))
                         for side in (0, 1)]
                yield pa.RecordBatch.from_arrays([*batch.slice(row, 1).columns, *lists], names=schema.fieldNames())

    return index.mapInArrow(run, schema)


# ------------------------------------------------------------------ the search
def added_at_most(single: np.ndarray, joint: np.ndarray) -> list[int]:
    """For each k what the first k terms can add together: the least sum over splits into terms and pairs."""
    bounds, before = [0], 0
    for i, (alone, together) in enumerate(zip(single.tolist(), joint.tolist())):
        best = bounds[i] + alone
        if i:
            best = min(best, bounds[i - 1] + max(alone, before, together))
        bounds.append(best)
        before = alone
    return bounds


def scored(block: Block, query: Query, impact: np.ndarray, bounds: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of all documents with a score of ``least`` (over 0) or more."""
    n = len(bounds) - 1
    if bounds[n] < least:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lists = lists_of(block, query)
    optional = max(k for k in range(n) if bounds[k] < least)  # bounds[0] is 0
    scores = np.zeros(len(block.sizes), np.int64)
    for k in range(optional, n):
        start, end = lists[k]
        scores[block.places[start:end]] += impact[start:end] * query.times[k]
    found = np.flatnonzero(scores)
    for k in range(optional - 1, -1, -1):
        found = found[scores[found] + bounds[k + 1] >= least]
        if not len(found):
            break
        start, end = lists[k]
        places = block.places[start:end]
        if not len(places):
            continue
        at = np.minimum(np.searchsorted(places, found), len(places) - 1)
        there = places[at] == found
        scores[found[there]] += impact[start:end][at[there]] * query.times[k]
    found = found[scores[found] >= least]
    return found, scores[found]


class Best:
    """The k best documents of a query so far, as a task finds them."""

    def __init__(self, least: int, size: int) -> None:
        self.least, self.size = max(least, 1), size
        self.held: list[tuple[int, tuple, object]] = []  # score, order of the identifier, identifier

    def add(self, ids: pa.Array, found: np.ndarray, scores: np.ndarray) -> None:
        if len(found) > self.size:
            edge = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            found, scores = found[scores >= edge], scores[scores >= edge]
        fresh = [(int(score), (i is None, 0 if i is None else i), i)
                 for i, score in zip(ids.take(pa.array(found)).to_pylist(), scores)]
        self.held = heapq.nsmallest(self.size, [*self.held, *fresh], key=lambda d: (-d[0], d[1]))
        if len(self.held) == self.size:
            self.least = max(self.least, self.held[-1][0])


def best_of_tasks(blocks: DataFrame, plan: Plan, least: Sequence[int], size: int) -> DataFrame:
    """(query, doc_id, score): for each task what may be among the best of all; scores of ``least`` are sure to be."""
    shipped = blocks.sparkSession.sparkContext.broadcast((plan, list(least)))
    id_type = blocks.schema["ids"].dataType.elementType
    schema = StructType([StructField("query", LongType()), StructField("doc_id", id_type), StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, least = shipped.value
        best = [Best(score, size) for score in least]
        kind = None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in range(len(batch)):
                block = Block.of_row(batch, row)
                single, joint = (batch.column(c)[row].values.to_numpy() for c in ("single", "joint"))
                impact = plan.impacts_of(block)
                for query, kept in zip(plan.queries, best):
                    if not len(query.terms):
                        continue
                    own = slice(query.offset, query.offset + len(query.terms))
                    bounds = added_at_most(single[own], joint[own])
                    found, scores = scored(block, query, impact, bounds, kept.least)
                    if len(found):
                        kept.add(block.ids, found, scores)
        rows = [(q, i, score) for q, kept in enumerate(best) for score, _, i in kept.held]
        if rows:
            queries, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=schema.fieldNames())

    return blocks.mapInArrow(run, schema)


def best_of(found: DataFrame, size: int) -> DataFrame:
    """The ``size`` best rows of each query with their rank, first within shares of the tasks and then over all."""
    share = (F.spark_partition_id() % SHARES).alias("_share")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    within = F.row_number().over(Window.partitionBy("query", "_share").orderBy(*order))
    merged = found.select("*", share).withColumn("rank", within).filter(F.col("rank") <= size).drop("_share")
    over_all = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return merged.withColumn("rank", over_all).filter(F.col("rank") <= size)


def first_thresholds(blocks: DataFrame, plan: Plan, size: int) -> list[int]:
    """For each query the ``size``-th best score among about ``FIRST_BLOCKS`` blocks, chosen by hash.

    No document below it can be in the result.
    """
    share = FIRST_BLOCKS / max(blocks.count(), 1)
    some = blocks.filter(F.pmod(F.xxhash64("sizes"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    rows = best_of(best_of_tasks(some, plan, [0] * len(plan.queries), size), size)
    known = {r["query"]: r.score for r in rows.filter(F.col("rank") == size).collect()}
    return [known.get(q, 0) for q in range(len(plan.queries))]


def search_at_once(docs: DataFrame, items: DataFrame, texts: Sequence[tuple[int, str | None]], size: int) -> DataFrame:
    """``search`` for a number of queries that fits the driver."""
    spark = docs.sparkSession
    vocabulary = sorted({term for _, text in texts for term in terms(text)})
    number_of = {term: i for i, term in enumerate(vocabulary)}
    index = staged(indexed(docs, vocabulary), "search_index")
    plan = plan_of([text for _, text in texts], number_of, *frequencies(index))
    blocks = staged(with_bounds(index, plan), "search_bounds")
    found = best_of(best_of_tasks(blocks, plan, first_thresholds(blocks, plan, size), size), size)
    numbers = spark.createDataFrame([(q, number) for q, (number, _) in enumerate(texts)], "query long, _row long")
    # As many rows as queries at once.
    named = F.broadcast(numbers.join(items.select("_row", "item_id"), "_row"))
    return found.join(named, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, size: int = TOP, at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """The ``size`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text): (item_id, rank, doc_id, score)."""
    numbered = staged(items.select("item_id", "text", F.monotonically_increasing_id().alias("_row")), "search_items")
    rows = numbered.select("_row", "text").orderBy("_row").toLocalIterator()
    out, texts = None, []

    def more(out: DataFrame | None) -> DataFrame:
        part = search_at_once(docs, numbered, texts, size)
        return part if out is None else out.unionByName(part)

    for row in rows:
        texts.append((row["_row"], row["text"]))
        if len(texts) >= at_once:
            out, texts = more(out), []
    return more(out) if texts or out is None else out


SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
postings AS (SELECT d, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
lengths AS (SELECT d, sum(tf)::BIGINT AS n FROM postings GROUP BY d),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, corpus GROUP BY term),
impacts AS (
  SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS impact
  FROM postings JOIN lengths USING (d) JOIN weights USING (term), corpus),
item_terms AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
scores AS (
  SELECT q, item_id, d, doc_id, sum(times * impact)::BIGINT AS score
  FROM item_terms JOIN impacts USING (term) GROUP BY ALL HAVING sum(times * impact) > 0)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores)
WHERE rank <= 20
"""
