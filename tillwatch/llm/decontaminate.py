"""Benchmark decontamination by spaced-seed hashing (operator 3).

A seed is a fixed mask laid over consecutive tokens; the tokens under its zeros
do not count. Hashes of all seeds of the texts are joined with those of the
benchmark. A hit fixes how text and item lie on each other; the tokens around it
are then compared place by place, so that substituted tokens are tolerated.

The two masks together miss no stretch of 13 tokens with up to two substitutions
(the tests try all). Hashes are made from the scan on, and only hits are shuffled,
as hashes and numbers; a second scan picks the documents with hits and keeps the
tokens that lie on an item. The benchmark's hashes and the hits are broadcast if
there are at most ``MOST_BROADCAST`` of them (48 bytes each at most), and are
joined by shuffle beyond that. Tokens are words of letters and digits; in scripts
that put no blanks between words, each letter is one.

Defined cases: null and empty texts and items have no tokens and match nothing;
items of less than 13 tokens have to be found whole, with the same share of
substitutions; those with fewer tokens than the longest mask have to be found
whole and unchanged, by a hash of all their tokens, so an item of one common
word matches each document that has it; rows are told apart by identifier and
text, so a document without an identifier, or with another one's, is judged by
its own text, and equal rows count as one; equal items are all reported; an empty
table gives no matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.llm.shared import staged

# The masks.
MASKS = ("1111011", "110010111")
STRETCH = 13
SUBSTITUTIONS = 2  # in a stretch
MOST_BROADCAST = 250_000
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
# The plain letters and digits come first, as they decide most places.
TOKEN = rf"[a-z0-9[\p{{L}}\p{{N}}&&[^{UNSPACED}]]]++|[\p{{L}}\p{{N}}]\p{{M}}*+"
COLUMNS = ("doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_same")
ROW = ("_row_a", "_row_b")


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-case words of letters and digits, and of single letters of ``UNSPACED`` scripts."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with 128 bits that tell rows apart."""
    return docs.withColumns({
        ROW[0]: F.xxhash64(F.lit(1), "doc_id", "text"), ROW[1]: F.xxhash64(F.lit(2), "text", "doc_id")})


def seeds(rows: DataFrame, keys: Sequence[str], masks: Sequence[str] = MASKS, sizes: Sequence[int] = ()) -> DataFrame:
    """``rows`` (keys, _hashes) as (keys, _at, _seed): a row for each place and mask, and for each run of ``sizes`` tokens.

    Places come from an outer explode: for another one a filter would be derived, which works out all hashes twice.
    """
    n = F.size("_hashes")
    placed = rows.select(
        *keys, "_hashes", F.explode_outer(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).alias("_at"))

    def under(places: Sequence[int]) -> list[Column]:
        # Past the end of the tokens a place reads as null, which the hash skips; such seeds only cost a comparison.
        return [F.get("_hashes", F.col("_at") + i) for i in places]

    made = [F.xxhash64(F.lit(number), *under([i for i, bit in enumerate(mask) if bit == "1"]))
            for number, mask in enumerate(masks)]
    made += [F.when(F.col("_at") + size <= n, F.xxhash64(F.lit(-size), *under(range(size)))) for size in sizes]
    return placed.select(*keys, "_at", F.explode(F.array(*made)).alias("_seed"))


def own_seeds(items: DataFrame, masks: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """The seeds of ``items`` (_number, _hashes): masks for items they fit on, and all tokens of shorter ones."""
    longest, shortest = max(map(len, masks)), min(map(len, masks))
    long = seeds(items.filter(F.size("_hashes") >= longest), ["_number", "_hashes"], masks)
    long = long.filter(F.col("_at") + shortest <= F.size("_hashes"))
    short = items.filter(F.size("_hashes").between(1, longest - 1))
    parts = [seeds(short.filter(F.size("_hashes") == size), ["_number", "_hashes"], (), [size]).filter("_at = 0")
             for size in sizes]
    return reduce(DataFrame.union, [p.select("_number", "_at", "_seed") for p in [long, *parts]])


def joined(rows: DataFrame, few: DataFrame, on: Sequence[str], n_few: int, how: str = "inner") -> DataFrame:
    """A join with a table of ``n_few`` rows, which is broadcast up to ``MOST_BROADCAST`` of them."""
    return rows.join(F.broadcast(few) if n_few <= MOST_BROADCAST else few, list(on), how)


def hits(docs: DataFrame, items: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """Distinct (ROW, _number, _shift) of ``docs`` (ROW, _hashes): item place 0 lies on document place ``_shift``."""
    short = items.filter(F.size("_hashes").between(1, max(map(len, masks)) - 1))
    # As many sizes as the longest mask has places, less one.
    sizes = sorted(r[0] for r in short.select(F.size("_hashes")).distinct().collect())
    wanted = own_seeds(items, masks, sizes).withColumnRenamed("_at", "_item_at")
    found = joined(seeds(docs, ROW, masks, sizes), wanted, ["_seed"], wanted.count())
    return found.select(*ROW, "_number", (F.col("_at") - F.col("_item_at")).alias("_shift")).distinct()


def laid(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """Tokens of documents and items where they lie on each other: (ROW, doc_id, item_id, _start, _item_start, _part, _item)."""
    of_item = items.select("_number", "item_id", F.col("_hashes").alias("_item"), F.size("_hashes").alias("_n_item"))
    sized = found.join(of_item.select("_number", "_n_item"), "_number")
    near = joined(docs, sized, ROW, found.count())  # documents without hits are not tokenised again
    start, item_start = F.greatest(F.col("_shift"), F.lit(0)), F.greatest(-F.col("_shift"), F.lit(0))
    part = F.slice(token_hashes(F.col("text")), start + 1, F.col("_n_item") - item_start)
    parts = near.select(
        *ROW, "doc_id", "_number", start.alias("_start"), item_start.alias("_item_start"), part.alias("_part"))
    return staged(parts, "overlaps").join(of_item, "_number").withColumn(
        "_item_part", F.slice("_item", F.col("_item_start") + 1, F.size("_part")))


def verified(pairs: DataFrame) -> DataFrame:
    """Rows of ``laid`` that agree on a stretch, with its place and length."""
    stretch = F.least(F.lit(STRETCH), F.col("_n_item"))
    need = F.col("_stretch") - F.floor(F.col("_stretch") * SUBSTITUTIONS / STRETCH)
    total = lambda a: F.reduce(a, F.lit(0), lambda s, v: s + v)
    good = F.filter(
        F.sequence(F.lit(1), F.size("_same") - F.col("_stretch") + 1),
        lambda i: total(F.slice("_same", i, F.col("_stretch"))) >= need)
    same = F.zip_with("_part", "_item_part", lambda a, b: (a == b).cast("int"))
    agreed = (
        pairs.withColumns({"_stretch": stretch, "_same": same}).filter(F.size("_part") >= F.col("_stretch"))
        .withColumn("_good", good).filter(F.size("_good") > 0)
    )
    first, last = F.element_at("_good", 1), F.element_at("_good", -1) + F.col("_stretch") - 1
    n = last - first + 1
    return agreed.select(
        *ROW, "doc_id", "item_id", "_number", (F.col("_start") + first - 1).alias("doc_start"),
        (F.col("_item_start") + first - 1).alias("item_start"), n.alias("n_tokens"),
        total(F.slice("_same", first, n)).alias("n_same"))


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """The best overlap of each row of ``docs`` and each item, with ``ROW``."""
    rows = with_row(docs.select("doc_id", "text"))
    items = staged(benchmark.select(
        "item_id", token_hashes(F.col("text")).alias("_hashes"), F.monotonically_increasing_id().alias("_number")), "items")
    found = staged(hits(rows.select(*ROW, token_hashes(F.col("text")).alias("_hashes")), items, masks), "hits")
    spans = verified(laid(rows, items, found))
    best = F.struct("n_same", "n_tokens", -F.col("doc_start"), -F.col("item_start"))
    kept = F.max_by(F.struct("doc_id", "item_id", *COLUMNS[2:]), best).alias("_best")
    return spans.groupBy(*ROW, "_number").agg(kept).select(*ROW, "_best.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """Overlaps of ``docs`` (doc_id, text) and ``benchmark`` (item_id, text): the best of each pair."""
    return overlaps(docs, benchmark, masks).select(*COLUMNS)


def clean(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """``docs`` without the rows that overlap a benchmark item."""
    bad = staged(overlaps(docs, benchmark, masks).select(*ROW).distinct(), "contaminated")
    own = docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c in ROW})
    kept = joined(with_row(own), bad, ROW, bad.count(), "left_anti").drop(*ROW)
    return kept.withColumnsRenamed({f"_own_{c}": c for c in docs.columns if c in ROW})
