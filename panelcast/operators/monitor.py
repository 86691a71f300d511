"""Model monitoring over a predictions history ``(entity..., date, actual, predicted)``.

W12 moving-average accuracy, W13 decay rate, W14 declining run, A22 balance
index, F28 adaptation, F29 recommendations, Q11 the report.  All per entity;
every window is bounded by the history length of one entity (one row per
date), and the report is one aggregate row per entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MonitorConfig
from ..functions import labels as L
from .align import series_window


def accuracy_col(actual: str = "actual", predicted: str = "predicted") -> Column:
    """Daily accuracy = 100 - |(actual - predicted) / actual| * 100."""
    return 100 - F.abs(F.try_divide(F.col(actual) - F.col(predicted), F.col(actual))) * 100


def moving_average_accuracy(df: DataFrame, windows: Sequence[int] = (7, 30), entity: Sequence[str] = (),
                            time: str = "date", actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``MAcc_{w}d`` = mean daily accuracy over the last ``w`` rows
    (at least one), per entity."""
    w = series_window(entity, time)
    acc = df.withColumn("_acc", accuracy_col(actual, predicted))
    cols = {f"MAcc_{k}d": F.avg("_acc").over(w.rowsBetween(-(k - 1), Window.currentRow)) for k in windows}
    return acc.select(*entity, time, *[c.alias(n) for n, c in cols.items()])


def drift_columns(macc_col: str, cfg: MonitorConfig, rn: str = "_rn", n: str = "_n") -> dict[str, Column]:
    """Aggregates over a MAcc table with ``_rn`` = row index from the end
    (1 = latest), ``_lag`` = previous value, giving W13, W14 and F26."""
    latest = F.max(F.when(F.col(rn) == 1, F.col(macc_col)))
    prev = F.max(F.when(F.col(rn) == 2, F.col(macc_col)))
    raw = (prev - latest) if cfg.decay_sign == "reference" else (latest - prev)
    decay = F.when(F.max(n) < 2, F.lit(0.0)).otherwise(raw)
    step_down = F.coalesce(F.col(macc_col) < F.col(f"_lag_{macc_col}"), F.lit(True))
    declining = F.coalesce(F.bool_and(F.when(F.col(rn) <= cfg.decline_rows - 1, step_down)), F.lit(True))
    return {"current": latest, "decay_rate": decay, "is_declining": declining}


def monitoring_report(preds: DataFrame, cfg: MonitorConfig = MonitorConfig(), entity: Sequence[str] = (),
                      time: str = "date", actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Q11: one row per entity with accuracy, drift (7d/30d), balance,
    adaptation and recommendations (single-row struct report per entity)."""
    macc = moving_average_accuracy(preds, cfg.windows, entity, time, actual, predicted)
    w = series_window(entity, time)
    wd = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy(F.col(time).desc())
    mcols = [f"MAcc_{k}d" for k in cfg.windows]
    first, second = mcols[0], mcols[1] if len(mcols) > 1 else mcols[0]
    macc = macc.withColumns({f"_lag_{c}": F.lag(c).over(w) for c in mcols}).withColumns(
        {"_rn": F.row_number().over(wd), "_n": F.count(F.lit(1)).over(Window.partitionBy(*entity))})
    d1, d2 = drift_columns(first, cfg), drift_columns(second, cfg)
    tail_k = cfg.adaptation_rows
    in_tail = F.col("_rn") <= tail_k
    x = (F.col("_n") - F.col("_rn")).cast("double")  # index inside the tail is x - (n - k)
    agg = macc.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("data_points"), F.min(time).alias("start"), F.max(time).alias("end"),
        d1["current"].alias("current_7d"), d2["current"].alias("current_30d"),
        d1["decay_rate"].alias("decay_rate_7d"), d2["decay_rate"].alias("decay_rate_30d"),
        d1["is_declining"].alias("is_declining_7d"), d2["is_declining"].alias("is_declining_30d"),
        F.var_samp(F.when(in_tail, F.col(first))).alias("_var"),
        F.regr_slope(F.when(in_tail, F.col(first)), F.when(in_tail, x)).alias("_slope"))
    bal = preds.groupBy(*entity).agg(
        ((F.count_if(F.col(predicted) > F.col(actual)) - F.count_if(F.col(predicted) < F.col(actual)))
         / F.count(F.lit(1))).alias("balance_index"))
    rep = agg.join(bal, list(entity), "left") if entity else _attach(agg, bal)
    enough = F.col("data_points") >= tail_k
    rep = rep.withColumns({
        "drift_detected_7d": (F.col("decay_rate_7d") < cfg.drift_threshold) | F.col("is_declining_7d"),
        "drift_detected_30d": (F.col("decay_rate_30d") < cfg.drift_threshold) | F.col("is_declining_30d"),
        "severity_7d": L.drift_severity("decay_rate_7d", cfg.drift_threshold),
        "severity_30d": L.drift_severity("decay_rate_30d", cfg.drift_threshold),
        "bias": L.bias_class("balance_index"),
        "speed": F.when(enough, L.stability_class("_var")).otherwise(F.lit("N/A")),
        "variance": F.when(enough, F.col("_var")),
        "trend": F.when(enough, L.slope_trend("_slope")),
        "slope": F.when(enough, F.col("_slope")),
    }).drop("_var", "_slope")
    return rep.withColumn("recommendations", L.recommendations(
        "drift_detected_7d", "current_7d", "balance_index", "speed"))


def _attach(a: DataFrame, b: DataFrame) -> DataFrame:
    from .stats import attach_stats
    return attach_stats(a, b)


def keep_latest(history: DataFrame, order: str = "generated_at", keep: int = 100,
                entity: Sequence[str] = ()) -> DataFrame:
    """Keep the newest ``keep`` reports (per entity)."""
    from .stats import tail_rows
    return tail_rows(history, keep, entity, order)
