"""N-gram Jaccard join by MinHash banding (operator 10).

Links are pairs of documents whose sets of five-word n-grams have a Jaccard
similarity of 0.8 or more. The number of bands and rows follows from the recall
wanted at that similarity.

1. Each text becomes a set of n-gram hashes; documents with equal sets are one
   class and go on as one. The class has the hashes of its bands.
2. Classes that agree on a band are in one bucket. Buckets with the same members
   as one of an earlier band are left out.
3. A bucket is cut into tiles of a bounded number of texts and of n-grams; each
   pair of tiles is a task's unit of work. It gets the texts, and verifies all
   pairs on their full sets with matrix products over a slice of the hashes each.
   A pair is counted in the first band it shares, so once. No pairs are written:
   a unit gives the number of links of each member and one edge to its smallest
   relation, a forest of the links found.
4. Connected components of the forest give each document its class id, by
   alternating large-star and small-star steps until nothing changes.

The work on a group of n different near copies is n * n / 2 comparisons, as the
number of links is exact; it is dealt out by tiles, and rows stay in proportion
to n for each tile. Exact copies cost nothing beyond their first.

Defined cases: texts of one to four words have a single n-gram, all their words;
null texts and those without words have none, have no links and are their own
class; rows with one doc_id are separate documents of which each counts, equal ones too,
though the text of only one of them is read again; class
ids are the smallest doc_id of the class, null only where no member has one; an
empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.llm.arrays import Piece, mixed, pieces
from tillwatch.llm.shared import set_aside, staged
from tillwatch.operators.joins import lookup

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 128
TILE = 256
TILE_GRAMS = 1 << 22
SLICE_GRAMS = 1 << 21
COLUMN_BLOCK = 4096
SEED = 20
BROADCAST_ROWS = 500_000  # row hashes of 32 characters


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows to a band, so the fewest false candidates, with which that many hashes reach the recall."""
    for rows in range(most_hashes, 0, -1):
        chance = threshold**rows
        if chance >= 1:
            return 1, rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-chance)) if chance > 0 else math.inf
        if bands * rows <= most_hashes:
            return bands, rows
    return most_hashes, 1


def ngram_sets(p: Piece, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of the texts, one after the other and sorted in each, and the offsets of each text's."""
    hashes, _, texts = p.windows(n)
    for size in range(1, n):  # texts with fewer words than n
        short = np.flatnonzero(np.diff(p.word_offsets) == size)
        if len(short):
            total = np.full(len(short), size, np.uint64)
            for i in range(size):
                total = mixed(total + p.word_hashes[p.word_offsets[short] + i])
            hashes, texts = np.concatenate([hashes, total]), np.concatenate([texts, short])
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    return hashes[new], np.searchsorted(texts[new], np.arange(len(p) + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, ...]:
    """Two fingerprints of each set, and the hash of each of its bands; sets are not empty."""
    starts = offsets[:-1]
    first = np.add.reduceat(mixed(hashes), starts)
    second = np.add.reduceat(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.empty((len(starts), bands), np.uint64)
    for band in range(bands):
        total = np.full(len(starts), band, np.uint64)
        for factor in factors[band * rows:(band + 1) * rows]:
            least = np.minimum.reduceat((hashes * factor) >> np.uint64(16), starts)
            total = mixed(total ^ least)
        keys[:, band] = total
    return mixed(first ^ np.diff(offsets).astype(np.uint64)), second, keys


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def row_hash() -> Column:
    """128 bits of a row's doc_id and text as text; equal rows have the same."""
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), "doc_id", "text")), 16, "0") for seed in (1, 2)])


def sketch(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, row_id, n, s1, s2, bands).

    A hash of the row, and of its set the size, the fingerprints and the hashes of the bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, piece in pieces(batch.column(1)):
                hashes, offsets = ngram_sets(piece, n)
                sizes = np.diff(offsets)
                some = np.flatnonzero(sizes)
                s1, s2 = np.zeros((2, len(piece)), np.uint64)
                keys = np.zeros((len(piece), bands), np.uint64)
                if len(some):
                    s1[some], s2[some], keys[some] = signatures(
                        hashes, np.concatenate([offsets[some], offsets[-1:]]), bands, rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(piece) + 1, dtype=np.int32) * bands), signed(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(row, len(piece)) for c in ("doc_id", "row_id")),
                     pa.array(sizes.astype(np.int64)), signed(s1), signed(s2), lists],
                    names=["doc_id", "row_id", "n", "s1", "s2", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", row_hash().alias("row_id")).mapInArrow(
        run, f"doc_id {kind}, row_id string, n long, s1 long, s2 long, bands array<long>")


def buckets(sets: DataFrame) -> DataFrame:
    """``sets`` (s1, s2, n, bands) as members (band, key, size, grams, s1, s2) of the buckets worth looking into."""
    members = sets.select("s1", "s2", "n", F.posexplode("bands").alias("band", "key"))
    found = members.groupBy("band", "key").agg(
        F.count("*").alias("size"), F.sum("n").alias("grams"), F.bit_xor(F.xxhash64("s1", "s2")).alias("_x"),
        F.bit_xor(F.xxhash64("s2", "s1")).alias("_y"))
    # Buckets with the same members are the same; the first band's stays.
    same = found.filter("size > 1").groupBy("size", "grams", "_x", "_y")
    firsts = same.agg(F.min(F.struct("band", "key")).alias("_b"))
    return members.drop("n").join(firsts.select("size", "grams", "_b.band", "_b.key"), ["band", "key"])


def tiles(members: DataFrame, tile: int = TILE) -> DataFrame:
    """A row (band, key, part, other, side, s1, s2) for each unit of work that a member belongs to."""
    parts = F.greatest(F.ceil(F.col("size") / tile), F.least(F.ceil(F.col("grams") / TILE_GRAMS), "size")).cast("int")
    dealt = members.withColumns({"_parts": parts, "_part": F.pmod(F.xxhash64("s1", "s2", "band"), parts).cast("int")})
    paired = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return paired.select("band", "key", F.least("_part", "_with").alias("part"),
                         F.greatest("_part", "_with").alias("other"), (F.col("_part") > F.col("_with")).alias("side"),
                         "s1", "s2")


def linked(hashes: np.ndarray, offsets: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the sets are similar, as a matrix; the products of 0/1 rows count common hashes."""
    m = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(m, dtype=np.int32), sizes)
    shared = np.zeros((m, m), np.float32)
    slices = 1 + len(hashes) // SLICE_GRAMS
    part = ((hashes >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int32)
    for number in range(slices):
        here = slice(None) if slices == 1 else part == number
        of = owner[here]
        _, column, times = np.unique(hashes[here], return_inverse=True, return_counts=True)
        common = times > 1
        rank = np.cumsum(common) - 1
        use = common[column]
        of, column = of[use], rank[column[use]]
        order = np.argsort(column, kind="stable")
        of, column = of[order], column[order]
        for first in range(0, int(common.sum()), COLUMN_BLOCK):
            a, b = np.searchsorted(column, [first, first + COLUMN_BLOCK])
            block = np.zeros((m, min(COLUMN_BLOCK, int(common.sum()) - first)), np.float32)
            block[of[a:b], column[a:b] - first] = 1
            shared += block @ block.T
    union = sizes[:, None] + sizes[None, :] - shared
    return shared >= threshold * union - 1e-6


def roots(links: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component."""
    root = np.arange(len(links))
    while True:
        least = np.where(links, root[None, :], len(links)).min(1)
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def unit_links(keys: np.ndarray, band: int, side: np.ndarray, copies: np.ndarray, same_part: bool,
               hashes: np.ndarray, offsets: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each member of a unit of work, and the member its edge goes to."""
    links = linked(hashes, offsets, threshold)
    np.fill_diagonal(links, False)
    if not same_part:
        links &= side[:, None] != side[None, :]
    for earlier in range(band):
        links &= keys[:, None, earlier] != keys[None, :, earlier]
    return links @ copies, roots(links)


def verify(work: DataFrame, n: int, bands: int, rows: int, threshold: float) -> DataFrame:
    """``work`` (tiles with copies and text) as (s1, s2, links, r1, r2)."""
    unit = ["band", "key", "part", "other"]
    work = work.select(*unit, "side", "s1", "s2", "copies", "text")

    def one(table: pa.Table) -> pa.RecordBatch | None:
        found = [ngram_sets(piece, n) for _, piece in pieces(table["text"])]
        hashes = np.concatenate([h for h, _ in found])
        sizes = np.concatenate([np.diff(o) for _, o in found])
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        wanted = np.stack([table[c].to_numpy() for c in ("s1", "s2")], 1)
        s1, s2, keys = signatures(hashes, offsets, bands, rows)
        # Rows that share the hash of a member but not its set go, and so do repeated ones.
        own = (s1.view(np.int64) == wanted[:, 0]) & (s2.view(np.int64) == wanted[:, 1])
        _, firsts = np.unique(wanted[own], axis=0, return_index=True)
        rows_in = np.flatnonzero(own)[firsts]
        if len(rows_in) < 2:
            return None
        use = np.zeros(len(own), bool)
        use[rows_in] = True
        kept = np.flatnonzero(use)
        hashes = hashes[np.repeat(use, sizes)]
        offsets = np.concatenate(([0], np.cumsum(sizes[kept])))
        first = {c: table[c][0].as_py() for c in unit}
        links, root = unit_links(
            keys[kept], first["band"], table["side"].to_numpy()[kept], table["copies"].to_numpy()[kept],
            first["part"] == first["other"], hashes, offsets, threshold)
        some = np.flatnonzero(links)
        wanted = wanted[kept]
        return pa.RecordBatch.from_arrays(
            [pa.array(a) for a in (wanted[some, 0], wanted[some, 1], links[some].astype(np.int64),
                                   wanted[root[some], 0], wanted[root[some], 1])],
            names=["s1", "s2", "links", "r1", "r2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit; the last one of a batch may go on in the next."""
        rest: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            ids = np.stack([table[c].to_numpy() for c in unit], 1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                part = table.slice(a, b - a)
                if rest and any(rest[-1][c][0] != part[c][0] for c in unit):
                    if (out := one(pa.concat_tables(rest))) is not None:
                        yield out
                    rest = []
                rest.append(part)
        if rest and (out := one(pa.concat_tables(rest))) is not None:
            yield out

    dealt = work.repartition(*unit).sortWithinPartitions(*unit)
    return dealt.mapInArrow(run, "s1 long, s2 long, links long, r1 long, r2 long")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) as (node, root), the smallest node of each component, for the nodes with edges."""
    edges = staged(edges.filter("a != b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # The middle of a star may have most of the edges; ``lookup`` splits such keys.
        large = lookup(both.filter("b > a"), least, "a", "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = lookup(large, least, "a", "inner").select(
            F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        edges = staged(small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).filter("a != b").distinct(),
                       "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row_id, text) of the rows in ``wanted``, one of each; equal rows meet in their own task first."""
    texts = docs.select(row_hash().alias("row_id"), "text")
    ids = wanted.select("row_id").distinct()
    if ids.count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(ids), "row_id", "left_semi")
    return texts.groupBy("row_id").agg(F.first("text").alias("text"))


def members(docs: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, row_id, root, class_id, n_links, n_ngrams); ``root`` names the class."""
    bands, rows = bands_and_rows(threshold, recall)
    sketches = staged(sketch(docs, n, bands, rows), "sketches")
    kept = sketches.filter("n > 0")
    sets = kept.groupBy("s1", "s2").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.min("row_id").alias("row_id"))
    distinct = kept.select("s1", "s2", "n", "bands").dropDuplicates(["s1", "s2"])
    work = staged(tiles(buckets(distinct)).join(sets, ["s1", "s2"]), "tiles")
    # By a hash of id and text, as many rows may have one id, null among them.
    verified = staged(verify(work.join(texts_of(docs, work), "row_id"), n, bands, rows, threshold), "links")

    node = lambda a, b: F.concat(F.hex(a), F.lit("-"), F.hex(b))
    edges = verified.select(node("s1", "s2").alias("a"), node("r1", "r2").alias("b"))
    counted = verified.groupBy("s1", "s2").agg(F.sum("links").alias("links"))
    named = sets.join(counted, ["s1", "s2"], "left").withColumn("node", node("s1", "s2"))
    rooted = named.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("class_id"))
    info = lookup(rooted, ids, "root", "inner").select(
        "node", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = sketches.filter("n = 0").select(
        "doc_id", "row_id", F.col("row_id").alias("root"), F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"), F.col("n").alias("n_ngrams"))
    # One set may have most of the rows; ``lookup`` splits such keys.
    named_rows = kept.select("doc_id", "row_id", node("s1", "s2").alias("node"), "n")
    return (
        lookup(named_rows, info, "node", "inner", spread_by=["row_id"])
        .select("doc_id", "row_id", "root", "class_id", "n_links", F.col("n").alias("n_ngrams")).union(alone)
    )


def classes(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, class_id, n_links, n_ngrams), a row for each document.

    ``n_links`` is the number of other documents whose similarity reaches the threshold.
    """
    return members(docs, n, threshold, recall).select("doc_id", "class_id", "n_links", "n_ngrams")


def deduplicated(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each class: the one whose doc_id is the class id; of equal rows one stays."""
    docs, back = set_aside(docs, "_row")
    firsts = members(docs, n, threshold, recall).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    stay = firsts.groupBy("root").agg(F.min("row_id").alias("_row")).select("_row")
    # Equal rows meet in their own task first, and the texts are shuffled once for both steps.
    kept = docs.withColumn("_row", row_hash()).dropDuplicates(["_row"]).join(stay, "_row", "left_semi")
    return kept.select(*docs.columns).withColumnsRenamed(back)
