"""Composite feature-store builds.

C1  business-day store: bounds (A3) -> Mon-Fri calendar (F15) -> left joins
    (J1) -> forward+backward fill (W7) -> target (W2) -> lags / rolling /
    change (W1, W3, W4) -> drop incomplete rows (P10).
C3  daily calendar over the gold range; drops on gold and its lags only.
C4  full-outer alignment (J2) -> forward fill (W6) -> drop rows without gold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig
from ..operators.align import add_missing_series, calendar, date_bounds, fill, join_series
from ..operators.features import add_features


def _entities(series: Sequence[DataFrame], entity: Sequence[str]) -> DataFrame | None:
    if not entity:
        return None
    carriers = [s for s in series if all(c in s.columns for c in entity)]
    ents = carriers[0].select(*entity)
    for s in carriers[1:]:
        ents = ents.unionByName(s.select(*entity))
    return ents.distinct()   # partial-aggregated distinct


def business_day_store(spark: SparkSession, series: Sequence[DataFrame], cfg: FeatureConfig = FeatureConfig(),
                       daily: bool = False, bounds_from: Sequence[DataFrame] | None = None,
                       drop_subset: Sequence[str] | None = None) -> DataFrame:
    """C1 (``daily=False``) and C3 (``daily=True``) feature stores."""
    lo, hi = date_bounds(bounds_from or series, cfg.time)
    cal = calendar(spark, lo, hi, None if daily else cfg.calendar_weekdays, cfg.time,
                   entities=_entities(series, cfg.entity))
    panel = join_series(cal, series, cfg.entity, cfg.time, how="left")
    values = [c for c in panel.columns if c not in (*cfg.entity, cfg.time)]
    panel = fill(panel, values, cfg.entity, cfg.time, backward=cfg.backfill)
    feats = add_features(panel, cfg, cfg.present(values))
    if drop_subset is None:
        return feats.dropna(how="any")
    return feats.dropna(how="any", subset=list(drop_subset))


def full_outer_alignment(series: Sequence[DataFrame], cfg: FeatureConfig = FeatureConfig(),
                         optional: Sequence[str] = ("btc",), require: str = "gold") -> DataFrame:
    """C4: full-outer chain on date, forward fill, keep rows with ``require``."""
    first, rest = series[0], list(series[1:])
    panel = join_series(first, rest, cfg.entity, cfg.time, how="full")
    panel = add_missing_series(panel, optional)
    values = [c for c in panel.columns if c not in (*cfg.entity, cfg.time)]
    panel = fill(panel, values, cfg.entity, cfg.time, backward=False)
    return panel.filter(F.col(require).isNotNull())


# Relative nudge applied before rounding report values: averages of cent
# amounts often sit exactly on a decimal tie (e.g. x.69875), where Spark's
# decimal HALF_UP and a binary round-half-away can disagree.  The nudge moves
# such ties off the boundary identically in both engines.
TIE_NUDGE = 1.000000000001


def stable_round(c, digits: int = 4):
    return F.round(F.col(c) * F.lit(TIE_NUDGE) if isinstance(c, str) else c * F.lit(TIE_NUDGE), digits)


def round_doubles(df: DataFrame, digits: int = 4, skip: Sequence[str] = ()) -> DataFrame:
    """Report formatting: round every DOUBLE column (used for oracle output)."""
    return df.select(*[stable_round(f.name, digits).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") and f.name not in skip
                       else F.col(f.name) for f in df.schema.fields])
