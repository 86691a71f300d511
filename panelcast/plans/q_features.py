"""Registered queries: feature-store builds (C1-C4) and their parts."""

from __future__ import annotations

from ..config import FeatureConfig
from .feature_store import business_day_store, full_outer_alignment, round_doubles
from .registry import register
from .series import all_series
from .sqlgen import R, feature_store_sql

PANEL = FeatureConfig(entity=("o_orderpriority",))
SINGLE = FeatureConfig()


@register("c1_feature_store", ("C1", "S1", "A3", "F15", "J1", "W7", "W2", "W1", "W3", "W4", "P10", "P16"),
          feature_store_sql())
def c1_feature_store(spark, sf_dir):
    """Business-day feature store, one gold series per order priority."""
    return round_doubles(business_day_store(spark, all_series(spark, sf_dir), PANEL))


@register("c1_feature_store_single", ("C1", "J3"),
          feature_store_sql(variables=("gold", "fx", "cpi", "oil", "set"), entity=False))
def c1_feature_store_single(spark, sf_dir):
    """Reference case: one entity, no optional btc series (25 features)."""
    series = all_series(spark, sf_dir, with_btc=False, by_priority=False)
    return round_doubles(business_day_store(spark, series, SINGLE))


@register("c3_daily_store", ("C3", "F15", "W7", "P9"),
          feature_store_sql(variables=("gold", "fx", "cpi", "oil", "set"), entity=False, daily=True,
                            bounds_vars=("gold",), drop_subset=("gold", "gold_lag1", "gold_lag3")))
def c3_daily_store(spark, sf_dir):
    """Daily calendar over the gold range; drop only on gold and its lags."""
    series = all_series(spark, sf_dir, with_btc=False, by_priority=False)
    return round_doubles(business_day_store(spark, series, SINGLE, daily=True, bounds_from=[series[0]],
                                            drop_subset=("gold", "gold_lag1", "gold_lag3")))


@register("c2_feature_store_roll5", ("C2", "W3"),
          feature_store_sql(variables=("gold", "fx", "cpi", "oil", "set"), entity=False, roll=5,
                            roll_name="roll5"))
def c2_feature_store_roll5(spark, sf_dir):
    """Older builder variant: the rolling window is a parameter (5 rows,
    3 needed) and the column name follows it (``_roll5``)."""
    series = all_series(spark, sf_dir, with_btc=False, by_priority=False)
    cfg = FeatureConfig(roll=5, roll_name="roll5")
    return round_doubles(business_day_store(spark, series, cfg))


_C4_SQL = f"""
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1),
fx AS (SELECT CAST(strftime(l_shipdate, '%Y-%m') || '-01' AS DATE) AS date, avg(l_discount) AS fx
       FROM lineitem GROUP BY strftime(l_shipdate, '%Y-%m')),
cpi AS (SELECT CAST(strftime(l_shipdate, '%Y-%m') || '-01' AS DATE) AS date, avg(l_tax) AS cpi
        FROM lineitem GROUP BY strftime(l_shipdate, '%Y-%m')),
oil_b AS (SELECT strftime(l_shipdate, '%Y-%m') AS period, p_brand,
                 sum(l_extendedprice) / count(l_extendedprice) AS value
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
oil AS (SELECT CAST(period || '-01' AS DATE) AS date, avg(value) AS oil FROM oil_b GROUP BY 1),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS "set" FROM lineitem GROUP BY 1),
j AS (SELECT * FROM g FULL JOIN fx USING (date) FULL JOIN cpi USING (date) FULL JOIN oil USING (date)
      FULL JOIN s USING (date)),
f AS (SELECT date,
  last_value(gold IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gold,
  last_value(fx IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fx,
  last_value(cpi IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpi,
  last_value(oil IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS oil,
  last_value("set" IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "set",
  CAST(NULL AS DOUBLE) AS btc
  FROM j)
SELECT date, {R('gold')} AS gold, {R('fx')} AS fx, {R('cpi')} AS cpi, {R('oil')} AS oil,
       {R('"set"')} AS "set", btc
FROM f WHERE gold IS NOT NULL
"""


@register("c4_full_outer_alignment", ("C4", "J2", "J3", "W6", "P9", "A1"), _C4_SQL)
def c4_full_outer_alignment(spark, sf_dir):
    series = all_series(spark, sf_dir, with_btc=False, by_priority=False)
    return round_doubles(full_outer_alignment(series, SINGLE, optional=("btc",)))

