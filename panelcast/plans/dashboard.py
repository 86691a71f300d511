"""Dashboard (C8): the summary of Q13 (latest price, 30-row change and
volatility, 7-row trend and the classification signals, one row per entity),
correlations (A6), the newest forecast (S14), and their export (S22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators.stats import tail_correlations, tail_mean_pct_change, trailing_metrics
from ..sources.files import latest_snapshot_rows
from ..sources.versions import VersionedStore


def dashboard_summary(series: DataFrame, value: str, entity: Sequence[str] = (), time: str = "date",
                      digits: int = 4) -> DataFrame:
    m30 = trailing_metrics(series, value, 30, entity, time)
    t7 = tail_mean_pct_change(series, value, 7, entity, time)
    latest = series.groupBy(*entity).agg(F.max(time).alias("latest_date"))
    j = m30.join(t7, list(entity)).join(latest, list(entity)) if entity else None
    if j is None:
        from ..operators.stats import attach_stats
        j = attach_stats(attach_stats(m30, t7), latest)
    nudge = F.lit(1.000000000001)
    return j.select(
        *entity, "latest_date",
        F.round(F.col("current") * nudge, digits).alias("current_price"),
        F.round(F.col("change") * nudge, digits).alias("change_30d"),
        F.round(F.col("change_pct") * nudge, 6).alias("change_30d_pct"),
        F.round(F.col("volatility") * nudge, 6).alias("volatility"),
        F.round(F.col("avg_change_pct") * nudge, 6).alias("avg_change_7d_pct"),
        L.trend_class("avg_change_pct").alias("trend_7d"),
        L.volatility_class("volatility").alias("volatility_class"),
        L.outlook_class("avg_change_pct").alias("outlook"))


def dashboard(series: DataFrame, value: str, joined: DataFrame, others: Sequence[str], forecasts: DataFrame,
              entity: Sequence[str] = (), time: str = "date", rows: int = 180) -> dict[str, DataFrame]:
    """``summary`` of ``series``; ``correlations`` of ``value`` with
    ``others`` over the last ``rows`` rows of ``joined``; ``forecast``: the rows
    of the newest of the forecast snapshots in ``forecasts`` (a scan read with
    ``with_file=True``)."""
    return {"summary": dashboard_summary(series, value, entity, time),
            "correlations": tail_correlations(joined, value, others, rows, time=time),
            "forecast": latest_snapshot_rows(forecasts, by="mtime").drop("_file_name", "_file_mtime")}


def export_dashboard(sink: VersionedStore, tables: dict[str, DataFrame], run: str) -> int:
    """All tables of a dashboard in one commit; a rerun replaces itself."""
    return sink.commit(tables, run=run, info={"run": run})
