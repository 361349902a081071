"""The dashboard's reads, as DataFrames over the stored series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tillwatch import schemas as S
from tillwatch.operators import rollups


def panels(points: DataFrame, latency: DataFrame | None = None, now: Column | None = None) -> dict[str, DataFrame]:
    """One DataFrame per panel, over the trailing view of the retained points.

    ``points`` and ``latency`` are ``(series, ts, value)``. Without ``now`` the
    view ends at the newest point.
    """
    view = rollups.trailing(rollups.retained(points), now=now)
    out = {
        "fraud_gauge": rollups.gauge(view),
        "fraud_over_time": rollups.rollup_series(view, S.SERIES_FRAUD, "sum"),
        "fraud_summary": rollups.reduce_series(view.filter(view.series == S.SERIES_FRAUD)),
        "amount": rollups.rollup_series(view, S.SERIES_AMOUNT, "sum"),
        "throughput": rollups.rollup_series(view, S.SERIES_COUNT, "sum"),
        "total_transactions": rollups.rollup_series(view, S.SERIES_COUNT, "max"),
    }
    if latency is not None:
        recent = rollups.trailing(rollups.retained(latency), now=now)
        out |= {f"latency_{topic}": rollups.read_series(recent, series) for topic, series in S.LATENCY_SERIES.items()}
    return out
