"""Classification rules (F23-F30) as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels of the reference's reports.
TREND_FLAT_BAND = 0.1          # F23: abs(avg daily change %) below -> flat
DIRECTION_FLAT_BAND = 0.5      # F24: abs(change %) below -> flat
VOLATILITY_HIGH = 1.5          # F25
VOLATILITY_LOW = 0.5           # F25
OUTLOOK_BAND = 0.5             # F25
DRIFT_HIGH = -1.0              # F26
BIAS_BAND = 0.1                # F27
STABLE_VAR = 0.1               # F28
MODERATE_VAR = 0.5             # F28
TRADEOFF_EXCELLENT = 300       # F30
TRADEOFF_GOOD = 100            # F30


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trend_class(avg_change_pct) -> Column:
    """``flat`` / ``up`` / ``down``."""
    x = _col(avg_change_pct)
    return (F.when(x.isNull(), F.lit(None))
            .when(F.abs(x) < TREND_FLAT_BAND, "flat")
            .when(x > 0, "up").otherwise("down"))


def direction_class(change_pct) -> Column:
    """forecast direction."""
    x = _col(change_pct)
    return (F.when(x.isNull(), F.lit(None))
            .when(F.abs(x) < DIRECTION_FLAT_BAND, "flat")
            .when(x > 0, "up").otherwise("down"))


def volatility_class(volatility) -> Column:
    """``high`` / ``low`` / ``medium``."""
    x = _col(volatility)
    return (F.when(x.isNull(), F.lit(None))
            .when(x > VOLATILITY_HIGH, "high").when(x < VOLATILITY_LOW, "low").otherwise("medium"))


def outlook_class(avg_change_pct) -> Column:
    """``up`` / ``down`` / ``flat``."""
    x = _col(avg_change_pct)
    return (F.when(x.isNull(), F.lit(None))
            .when(x > OUTLOOK_BAND, "up").when(x < -OUTLOOK_BAND, "down").otherwise("flat"))


def drift_severity(decay_rate, threshold: float = -0.5) -> Column:
    """``HIGH`` / ``MEDIUM`` / ``LOW``."""
    x = _col(decay_rate)
    return F.when(x < DRIFT_HIGH, "HIGH").when(x < threshold, "MEDIUM").otherwise("LOW")


def bias_class(balance_index) -> Column:
    """``OVER-PREDICT`` / ``UNDER-PREDICT`` / ``BALANCED``."""
    x = _col(balance_index)
    return (F.when(x > BIAS_BAND, "OVER-PREDICT").when(x < -BIAS_BAND, "UNDER-PREDICT")
            .otherwise("BALANCED"))


def stability_class(variance) -> Column:
    """``STABLE`` / ``MODERATE`` / ``VOLATILE``."""
    x = _col(variance)
    return F.when(x < STABLE_VAR, "STABLE").when(x < MODERATE_VAR, "MODERATE").otherwise("VOLATILE")


def slope_trend(slope) -> Column:
    """``IMPROVING`` / ``DECLINING`` / ``STABLE`` by slope sign."""
    x = _col(slope)
    return F.when(x > 0, "IMPROVING").when(x < 0, "DECLINING").otherwise("STABLE")


def tradeoff_score(accuracy_pct, latency_ms) -> Column:
    """accuracy % per millisecond."""
    return F.try_divide(_col(accuracy_pct), _col(latency_ms))


def tradeoff_class(score) -> Column:
    x = _col(score)
    return (F.when(x.isNull(), F.lit(None))
            .when(x > TRADEOFF_EXCELLENT, "excellent").when(x > TRADEOFF_GOOD, "good")
            .otherwise("poor"))


# Monitoring recommendations, in the order they are tested.
REC_DRIFT = "⚠️  Concept drift detected (7d). Consider retraining the model."
REC_LOW_ACCURACY = "📉 Accuracy below 95%. Investigate feature quality."
REC_BIAS = "⚖️  Model is biased ({}). Check training data balance."
REC_VOLATILE = "📊 High volatility detected. Monitor closely for next few days."
REC_STABLE = "✅ Model performance is stable."
LOW_ACCURACY = 95.0
BIAS_ALERT = 0.2


def recommendations(drift_7d, macc_7d, balance_index, speed) -> Column:
    """list of recommendation strings, a default when none applies."""
    bias_text = F.format_string(REC_BIAS.replace("{}", "%s"), bias_class(balance_index))
    recs = F.filter(F.array(
        F.when(_col(drift_7d), F.lit(REC_DRIFT)),
        F.when(_col(macc_7d) < LOW_ACCURACY, F.lit(REC_LOW_ACCURACY)),
        F.when(F.abs(_col(balance_index)) > BIAS_ALERT, bias_text),
        F.when(_col(speed) == "VOLATILE", F.lit(REC_VOLATILE)),
    ), lambda r: r.isNotNull())
    return F.when(F.size(recs) > 0, recs).otherwise(F.array(F.lit(REC_STABLE)))
