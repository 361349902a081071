"""The cut-off of a score, learned from labels: exact area under the curve, best cut-off, isotonic calibration.

Rows of one score are combined first. The scores are cut into ranges, whose
counts are added up in order, and then the scores within each range; no task
holds all scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tillwatch.sources.workspace import written

RANGES = 1024


def running_counts(rows: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """A row for each score with its labels (_pos, _neg) and those of all greater scores (_pos_above, _neg_above).

    Rows without a score or a label are left out. Scores are between 0 and 1 for
    even ranges; others are right, too, and meet in the first or the last one.
    The counts are written once, as they are read for the ranges, within them and
    for the totals; the rows are read once.
    """
    known = rows.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    place = F.floor(F.col("_score") * ranges)
    scores = known.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    counted = written(scores, "scores").withColumn("_range", F.least(F.greatest(place, F.lit(0)), F.lit(ranges - 1)))
    sums = counted.groupBy("_range").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    over = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)  # ``ranges`` rows at most
    starts = sums.select("_range", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"{c}0") for c in ("_p", "_n")])
    inside = Window.partitionBy("_range").orderBy(F.desc("_score")).rowsBetween(Window.unboundedPreceding, -1)
    return counted.join(F.broadcast(starts), "_range").select(
        "_score", "_pos", "_neg", *[
            (F.col(f"{c[:2]}0") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_above") for c in ("_pos", "_neg")])


def auc_and_cutoff(rows: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """One row: ``auc`` with ties counted half, and the ``cutoff`` (score >= cutoff) of the greatest difference of rates.

    Of equally good cut-offs the greatest. Null where there is no row of one of the classes.
    """
    counts = running_counts(rows, score, label, ranges)
    totals = counts.agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    both = counts.join(F.broadcast(totals))  # one row
    caught, alarms = F.col("_pos_above") + F.col("_pos"), F.col("_neg_above") + F.col("_neg")
    # Whole numbers, so that ties are ties: the difference of the rates times both totals.
    gain = (caught * F.col("_n") - alarms * F.col("_p")).cast("decimal(38,0)")
    best = F.max_by(F.struct(F.col("_score").alias("cutoff"), caught.alias("tp"), alarms.alias("fp")),
                    F.struct(gain, "_score"))
    area = F.sum((F.col("_neg") * (2 * F.col("_pos_above") + F.col("_pos"))).cast("decimal(38,0)"))
    found = both.agg(area.alias("_area"), best.alias("_best"), F.first("_p").alias("_p"), F.first("_n").alias("_n"))
    pairs = F.nullif(F.col("_p").cast("double") * F.col("_n"), F.lit(0.0))
    return found.select(
        (F.col("_area").cast("double") / (2 * pairs)).alias("auc"),
        F.when(pairs.isNotNull(), F.col("_best.cutoff")).alias("cutoff"),
        F.when(pairs.isNotNull(), F.col("_best.tp")).alias("true_positives"),
        F.when(pairs.isNotNull(), F.col("_best.fp")).alias("false_positives"))


def pooled(groups: list[tuple[float, float, float, float]]) -> list[tuple[float, float, float, float]]:
    """(low, high, positives, rows) in order of score, neighbours pooled until shares of positives rise."""
    out: list[tuple[float, float, float, float]] = []
    for group in groups:
        out.append(group)
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            (low, _, p1, n1), (_, high, p2, n2) = out[-2:]
            out[-2:] = [(low, high, p1 + p2, n1 + n2)]
    return out


def isotonic(rows: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """(low, high, probability, n): calibration by pooling neighbours, rising with the score.

    Each range of scores is pooled by a task, and what is left of all ranges by
    one: pooling a part first changes nothing, as what is pooled there stays so.
    """
    counts = running_counts(rows, score, label, ranges).select(
        F.col("_score").alias("low"), F.col("_score").alias("high"), F.col("_pos").cast("double").alias("p"),
        (F.col("_pos") + F.col("_neg")).cast("double").alias("n"))
    schema = "low double, high double, p double, n double"

    def pool(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[float, float, float, float]] = []
        for frame in frames:
            held = pooled([*held, *frame.itertuples(index=False, name=None)])
        if held:
            yield pd.DataFrame(held, columns=["low", "high", "p", "n"])

    parts = counts.repartitionByRange("low").sortWithinPartitions("low").mapInPandas(pool, schema)
    whole = parts.coalesce(1).sortWithinPartitions("low").mapInPandas(pool, schema)
    return whole.select("low", "high", (F.col("p") / F.col("n")).alias("probability"), F.col("n").cast("long").alias("n"))
