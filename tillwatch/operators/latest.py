"""Latest row per key: the upsert view over an append-only change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def instant(text: str) -> Column:
    """The moment that an ISO 8601 text names, so that offsets and fractions of any length compare; null if none."""
    return F.col(text).try_cast("timestamp")


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the one with the greatest ``order_by`` values.

    ``max_by`` keeps one row per key and task before the shuffle, so a key that
    holds most of the log sends one row per task and not its whole history.
    End ``order_by`` with a unique column to make the choice deterministic.
    Select the columns you need first: the row travels as one struct, which
    column pruning does not look into.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [name for name in df.columns if name not in keys]
    if not payload:
        return df.distinct()
    kept = F.max_by(F.struct(*payload), F.struct(*order_by)).alias("_kept")
    return df.groupBy(*keys).agg(kept).select(*keys, "_kept.*").select(*df.columns)
