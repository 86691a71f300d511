"""Frozen configuration objects passed to the operators.

All defaults follow the reference pipeline: lags 1 and 3, a rolling mean over
7 rows needing at least 3 values, a Monday-Friday feature calendar and a
forecast calendar that only closes on Sunday.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's.
DEFAULT_VARS = ("gold", "fx", "cpi", "oil", "set", "btc")
OPTIONAL_VARS = ("btc",)
TARGET = "gold"
TARGET_NEXT = "gold_next"
LAGS = (1, 3)
ROLL_WINDOW = 7
ROLL_MIN_PERIODS = 3
FEATURE_CALENDAR_WEEKDAYS = (0, 1, 2, 3, 4)   # Monday..Friday (0 = Monday)
FORECAST_CLOSED_WEEKDAYS = (6,)               # Sunday
FORECAST_HORIZON = 7
MAX_FORECAST_DAYS = 30
GOLD_RANGE = (10_000.0, 100_000.0)
FX_RANGE = (20.0, 50.0)
OUTLIER_IQR_THRESHOLD = 3.0
OUTLIER_MIN_SUPPORT = 10
BE_YEAR_OFFSET = 543
BE_YEAR_CUTOFF = 2400
LEGACY_SUFFIXES = {"_roll7": "_roll7_mean", "_pct": "_pct_change"}
PRICE_TYPE = "gold_bar_sell"


@dataclass(frozen=True)
class FeatureConfig:
    """How a panel of series is turned into a feature store."""

    entity: tuple[str, ...] = ()
    time: str = "date"
    variables: tuple[str, ...] = DEFAULT_VARS
    target: str = TARGET
    lags: tuple[int, ...] = LAGS
    roll: int = ROLL_WINDOW
    min_periods: int = ROLL_MIN_PERIODS
    # Name stays ``_roll7_mean`` whatever ``roll`` is, as in the reference.
    roll_name: str = "roll7_mean"
    backfill: bool = True
    calendar_weekdays: tuple[int, ...] = FEATURE_CALENDAR_WEEKDAYS

    def present(self, columns) -> list[str]:
        cols = set(columns)
        return [v for v in self.variables if v in cols]


@dataclass(frozen=True)
class ForecastConfig:
    entity: tuple[str, ...] = ()
    time: str = "date"
    horizon: int = FORECAST_HORIZON
    closed_weekdays: tuple[int, ...] = FORECAST_CLOSED_WEEKDAYS
    skip_closed: bool = True
    price_type: str = PRICE_TYPE
    # keep: a lag whose predecessor lag is missing keeps its value;
    # base: it falls back to the current value of the variable.
    lag_fallback: str = "keep"

    def __post_init__(self):
        if not 1 <= self.horizon <= MAX_FORECAST_DAYS:
            raise ValueError(f"horizon must be in 1..{MAX_FORECAST_DAYS}")
        if len(set(self.closed_weekdays)) >= 7:
            raise ValueError("a calendar closed on all seven weekdays has no open day")


@dataclass(frozen=True)
class MonitorConfig:
    windows: tuple[int, ...] = (7, 30)
    drift_threshold: float = -0.5
    decline_rows: int = 5
    adaptation_rows: int = 10
    history_keep: int = 100
    # "reference": decay = previous - latest (a drop is positive);
    # "drop_is_negative": latest - previous.
    decay_sign: str = "reference"


@dataclass(frozen=True)
class ModelConfig:
    test_fraction: float = 0.2
    folds: int = 5
    seed: int = 42
    ridge_alpha: float = 1.0
    lasso_alpha: float = 0.1
    grid_alphas: tuple[float, ...] = (10, 50, 100, 500, 1000, 2000, 3000, 5000)
    extra: dict = field(default_factory=dict)
