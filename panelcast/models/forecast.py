"""Recursive multi-step forecasts (W20, M12, M13, M14, C6) for linear models.

The forecast of one entity is a fold over ``sequence(1, horizon)`` with
Spark's ``aggregate`` higher-order function: the state is a struct holding
the date, every feature used by the model and the rows emitted so far.  One
step scores the state (``intercept + sum(coef * x)``), moves to the next
open day and shifts the lag chain - O(1) work per step, all inside Catalyst,
in parallel over entities.

State update (the reference's skip-closed-days variant):
* target: ``target <- prediction``; ``target_lag1 <- target``;
  ``target_lagN <- target_lag(N-1)`` if present, otherwise kept
  (``lag_fallback='keep'``) or the target (``'base'``);
* other variables keep their value; ``x_lag1 <- x``;
  ``x_lagN <- x_lag(N-1)`` if present, else ``x``;
* rolling means and changes are not refreshed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ForecastConfig
from ..functions.dates import is_open_day, next_day, weekday_name
from ..operators.stats import attach_stats

_LAG = re.compile(r"^(.+)_lag(\d+)$")
OUT_TYPE = "array<struct<step:int,date:date,predicted_price:double,change:double,change_pct:double>>"


def parse_lag(name: str) -> tuple[str, int] | None:
    """``gold_lag3`` -> ("gold", 3)."""
    m = _LAG.match(name)
    return (m.group(1), int(m.group(2))) if m else None


def state_fields(features: Sequence[str], target: str) -> list[str]:
    fields = [target] + [f for f in features if f != target]
    for f in list(fields):
        lag = parse_lag(f)
        if lag and lag[0] not in fields:
            fields.append(lag[0])
    return fields


def next_row(s: Column, fields: Sequence[str], target: str, pred: Column, lag_fallback: str = "keep") -> dict:
    """The feature values of the next step from state ``s``."""
    have = set(fields)
    new = {}
    for f in fields:
        lag = parse_lag(f)
        if f == target:
            new[f] = pred
        elif lag:
            base, n = lag
            prev = f"{base}_lag{n - 1}"
            if n == 1:
                new[f] = s[base]
            elif prev in have:
                new[f] = s[prev]
            elif base == target:
                new[f] = s[f] if lag_fallback == "keep" else s[target]
            else:
                new[f] = s[base]
        else:
            new[f] = s[f]
    return new


def recursive_forecast(latest: DataFrame, model: DataFrame, features: Sequence[str], target: str = "gold",
                       cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """``horizon`` recursive steps per entity from its latest feature
    row and its linear model ``(entity..., intercept, coef)``."""
    entity, time = list(cfg.entity), cfg.time
    fields = state_fields(features, target)
    j = attach_stats(latest, model.drop("alpha") if "alpha" in model.columns else model, entity)
    init = F.struct(F.col(time).cast("date").alias("date"),
                    *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in fields],   # missing features count as 0
                    F.array().cast(OUT_TYPE).alias("out"))

    def step(s: Column, i: Column) -> Column:
        pred = F.col("intercept")
        for k, f in enumerate(features):
            pred = pred + F.col("coef")[k] * s[f]
        nd = next_day(s["date"], cfg.closed_weekdays, cfg.skip_closed)
        last = s[target]
        row = F.struct(i.cast("int").alias("step"), nd.alias("date"), pred.alias("predicted_price"),
                       (pred - last).alias("change"), (F.try_divide(pred - last, last) * 100).alias("change_pct"))
        nxt = next_row(s, fields, target, pred, cfg.lag_fallback)
        return F.struct(nd.alias("date"), *[nxt[f].alias(f) for f in fields],
                        F.concat(s["out"], F.array(row)).alias("out"))

    folded = F.aggregate(F.sequence(F.lit(1), F.lit(cfg.horizon)), init, step, lambda s: s["out"])
    return j.select(*entity, F.inline(folded))


def latest_rows(df: DataFrame, cols: Sequence[str], entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """K6: the latest row of each entity (``max_by`` over a struct)."""
    picked = df.groupBy(*entity).agg(F.max_by(F.struct(time, *[c for c in cols if c != time]), time).alias("_r"))
    return picked.select(*entity, "_r.*")


def forecast_table(forecast: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """``(date, day_name, predicted_price, price_type, change,
    change_pct, is_business_day)`` per entity."""
    return forecast.select(*cfg.entity, "step", "date", weekday_name("date").alias("day_name"), "predicted_price",
                           F.lit(cfg.price_type).alias("price_type"), "change", "change_pct",
                           is_open_day("date", cfg.closed_weekdays).alias("is_business_day"))


def one_step(latest: DataFrame, model: DataFrame, features: Sequence[str], target: str = "gold",
             cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Next-day score of the newest row with change / change %."""
    one = ForecastConfig(entity=cfg.entity, time=cfg.time, horizon=1, closed_weekdays=cfg.closed_weekdays,
                         skip_closed=cfg.skip_closed, price_type=cfg.price_type, lag_fallback=cfg.lag_fallback)
    f = recursive_forecast(latest, model, features, target, one)
    last = latest.select(*cfg.entity, F.col(cfg.time).alias("last_date"), F.col(target).alias("last_price"))
    return attach_stats(f, last, cfg.entity).select(
        *cfg.entity, "last_date", "last_price", F.col("date").alias("next_date"), "predicted_price", "change",
        "change_pct", is_open_day("date", cfg.closed_weekdays).alias("is_business_day"))
