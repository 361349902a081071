"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 4).

Every source gets a share of the words of the mix. A target is met by complete
passes over the source and then a part of one more pass, whose documents are
drawn without replacement with probability by quality weight: each document
has an exponential key, -ln(u) / weight, and the smallest keys come first.

No task holds a source. The keys are cut into ranges by the number of documents;
words are summed for each source and range, and the sums are added up along the
ranges. What lies in ranges before the one in which a budget ends is drawn, what
lies behind is not, and only the documents of that one range are sorted, which
gives the last key that is drawn. So texts are read once and never shuffled.

Documents are taken whole, the drawn ones as long as they fit. One more is taken,
the one whose size is nearest to what is left of the budget, if that brings the
source nearer to its target. The first that did not fit is among those to choose
from, so a source misses its target by no more than half of that document.

Defined cases: null and empty texts have no words, and none are taken; a null
source is a source of its own, last in order; keys are made of identifier and
text, so rows that share one of them are drawn apart; equal rows share their key
and are told apart by their place; an empty table gives an empty mix. Input
columns with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwatch.llm.shared import staged, unit_hash, without, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5  # of all words
MOST_PASSES = 2.0
ROWS_IN_RANGE = 5_000  # of all sources together
RANGE_WEIGHTS = (1.0, 0.3, 0.1)  # ranges are even for documents of about these weights
SYMBOLS = "#*$%&|<>"
LEAST_QUALITY = 0.1
SEED = "mix"
COLUMNS = ("size", "source_size", "target", "taken")


def quality_weight(text: Column) -> Column:
    """1 for clean text, down to ``LEAST_QUALITY`` as symbols reach a fifth of its characters."""
    length = F.length(text)
    symbols = length - F.length(F.translate(text, SYMBOLS, ""))
    share = F.least(F.lit(1.0), F.lit(5.0) * symbols / F.nullif(length, F.lit(0)))
    return F.lit(1.0) - F.coalesce(share, F.lit(0.0)) * F.lit(1.0 - LEAST_QUALITY)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most_passes: float = MOST_PASSES) -> DataFrame:
    """``sizes`` (_key, source_size), one row per source, with the words each gives to the mix.

    Weights repeat along the sources in code point order. Targets are filled like
    vessels: at one level of words per unit of weight, but never above
    ``most_passes`` times the source. The level follows from the sources in order
    of the level at which they are full. One row per source meets in one task here.
    """
    whole = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("_key")) - 1
    ranked = (
        sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most_passes)))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    order = Window.orderBy("_ratio", "_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(onward)
    levels = ranked.withColumn("_level", level).withColumn("_full", F.col("_ratio") <= F.col("_level"))
    final = F.max(F.when(~F.col("_full"), F.col("_level"))).over(whole)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(final * F.col("_weight"))
    return levels.select("_key", "source_size", target.alias("target"))


def keyed(docs: DataFrame, seed: str, ranges: int, carried: Sequence[str]) -> DataFrame:
    """``carried`` columns of ``docs`` with words, source key, exponential key and its range, which rises with the key."""
    place = sum((F.lit(1.0) - F.exp(-F.col("_draw") * w) for w in RANGE_WEIGHTS), F.lit(0.0)) / len(RANGE_WEIGHTS)
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit(""))))
    made = docs.select(
        *dict.fromkeys([*carried, "doc_id"]), word_count(F.col("text")).alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("x")).alias("_key"),  # null sorts last
        (-F.ln(unit_hash(name, seed)) / quality_weight(F.col("text"))).alias("_draw"))
    return made.withColumns({
        "_range": F.floor(place * ranges).cast("int"), "_place": F.monotonically_increasing_id()})


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_passes: float = MOST_PASSES,
        seed: str = SEED, ranges: int | None = None, carried: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size``, ``source_size``, ``target`` and ``taken`` words.

    ``carried`` are the columns of ``docs`` in the result, by default all of them.
    """
    docs = without(docs, *COLUMNS)
    carried = docs.columns if carried is None else list(carried)
    ranges = ranges or max(1, -(-docs.count() // ROWS_IN_RANGE))
    rows = staged(keyed(docs, seed, ranges, carried), "keyed")
    sums = rows.groupBy("_key", "_range").agg(F.sum("size").alias("_words"))
    sizes = sums.groupBy("_key").agg(F.sum("_words").alias("source_size"))
    passes = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    plan = targets(sizes, weights, share, most_passes).withColumn("_passes", passes).withColumn(
        "_rest", F.col("target") - F.col("_passes") * F.col("source_size"))

    # The range of each source in which its budget ends.
    along = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_words").over(along), F.lit(0))).join(plan, "_key")
    ends = starts.filter(F.col("_start") <= F.col("_rest")).groupBy("_key").agg(
        F.max_by(F.struct("_range", "_start", "_rest"), "_range").alias("_end")).select("_key", "_end.*")

    # The last key that is drawn there, and what is then left.
    own = rows.select("_key", "_range", "doc_id", "size", "_draw", "_place").join(ends, ["_key", "_range"])
    order = ["_draw", "doc_id", "size", "_place"]
    inside = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    drawn = own.withColumn("_upto", F.col("_start") + F.sum("size").over(inside)).filter("_upto <= _rest")
    cuts = drawn.groupBy("_key").agg(F.max(F.struct(*order)).alias("_cut"), F.max("_upto").alias("_upto"))
    # A row for each source; staged, so that its plan is not repeated in that of the texts.
    cut = staged(plan.join(ends.drop("_rest"), "_key", "left").join(cuts, "_key", "left").select(
        "_key", "source_size", "target", "_passes", F.col("_range").alias("_end"), "_cut",
        (F.col("_rest") - F.coalesce("_upto", "_start")).alias("_left")), "mix_cuts")

    is_drawn = (F.col("_range") < F.col("_end")) | (
        (F.col("_range") == F.col("_end")) & F.coalesce(F.struct(*order) <= F.col("_cut"), F.lit(False)))
    missed = F.abs(F.col("_left") - F.col("size"))
    others = rows.join(cut, "_key").filter(~is_drawn & (missed < F.col("_left")))
    nearest = others.groupBy("_key").agg(F.min(F.struct(missed.alias("_missed"), *order)).alias("_nearest"))
    decided = staged(cut.join(nearest.select("_key", F.col("_nearest._place").alias("_one_more")), "_key", "left"), "mix_plan")
    times = F.col("_passes") + F.coalesce(is_drawn | F.col("_place").eqNullSafe(F.col("_one_more")), F.lit(False)).cast("long")
    return rows.join(decided, "_key").withColumn("taken", (F.col("size") * times).cast("long")).select(*carried, *COLUMNS)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was taken, with the number of the pass."""
    mixed = without(mixed, "pass")
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return mixed.filter(times > 0).withColumn("pass", F.explode(F.sequence(F.lit(1), times)))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    -ln((('0x' || substr(md5(coalesce(cast(doc_id AS varchar), '') || ':' || md5(coalesce(text, '')) || ':mix'), 1, 13))::BIGINT
        + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
    / (1.0::DOUBLE - coalesce(least(1.0::DOUBLE, 5.0::DOUBLE
        * (length(text) - length(translate(text, '#*$%&|<>', ''))) / nullif(length(text), 0)), 0.0::DOUBLE)
        * 0.9::DOUBLE) AS draw
  FROM documents),
sources AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
    [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][cast((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS int)]
      AS weight
  FROM (SELECT source, cast(sum(size) AS bigint) AS source_size FROM sized GROUP BY source)),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, source_size, CASE WHEN cap / weight <= level THEN cap
    ELSE weight * max(CASE WHEN cap / weight > level THEN level END) OVER () END AS target
  FROM levels),
placed AS (
  SELECT d.doc_id, d.source, d.draw, d.size, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS passes,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
drawn AS (SELECT *, target - passes * source_size AS rest, upto <= target - passes * source_size AS fits FROM placed),
lefts AS (SELECT *, rest - coalesce(max(CASE WHEN fits THEN upto END) OVER (PARTITION BY source), 0) AS rem FROM drawn),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY source, fits ORDER BY abs(rem - size), draw, doc_id, size) = 1
    AND NOT fits AND abs(rem - size) < rem AS one_more
  FROM lefts)
SELECT doc_id, cast(size AS bigint) AS size, source_size, target,
  cast(size * (passes + CASE WHEN fits OR one_more THEN 1 ELSE 0 END) AS bigint) AS taken
FROM nearest
"""
