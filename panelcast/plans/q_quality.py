"""Registered queries: data-quality rule tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import FeatureConfig
from ..operators import quality as QL
from ..operators.features import feature_columns
from ..operators.project import rename_legacy
from .feature_store import business_day_store
from .registry import register
from .series import all_series, gold_series, read_table
from .sqlgen import feature_store_sql

FS_VARS = ("gold", "fx", "cpi", "oil", "set")


def _feature_store(spark, sf_dir):
    return business_day_store(spark, all_series(spark, sf_dir, with_btc=False, by_priority=False), FeatureConfig())


_FS_SQL = feature_store_sql(variables=FS_VARS, entity=False)
_REQUIRED = ["date", *FS_VARS, "gold_next", *feature_columns(FS_VARS, FeatureConfig(), include_raw=False)]
_PRICES = ["gold", "price", "close"]
_OPTIONAL = ["btc", "btc_lag1", "btc_lag3", "btc_roll7_mean", "btc_pct_change"]


@register("q1_feature_store_validation", ("Q1", "Q4", "D2", "W19", "A11"), f"""
WITH fs AS ({_FS_SQL}),
cols AS (SELECT column_name AS c, column_type AS t FROM (DESCRIBE {_FS_SQL})),
d AS (SELECT count(*) AS n, count(DISTINCT date) AS nd FROM fs),
nulls AS (SELECT {" + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in _REQUIRED if c != "date")} AS k FROM fs),
req AS (SELECT coalesce(string_agg(r, ',' ORDER BY i) FILTER (WHERE c IS NULL), '') AS missing,
               coalesce(string_agg(r, ',' ORDER BY i) FILTER (WHERE c IS NOT NULL AND r <> 'date'
                        AND t NOT IN ('DOUBLE', 'BIGINT', 'INTEGER', 'FLOAT') AND t NOT LIKE 'DECIMAL%'), '') AS bad
        FROM (SELECT unnest({_REQUIRED}) AS r, generate_subscripts({_REQUIRED}, 1) AS i) x LEFT JOIN cols ON r = c),
opt AS (SELECT coalesce(string_agg(r, ',' ORDER BY i) FILTER (WHERE c IS NULL), '') AS missing
        FROM (SELECT unnest({_OPTIONAL}) AS r, generate_subscripts({_OPTIONAL}, 1) AS i) x LEFT JOIN cols ON r = c),
price AS (SELECT coalesce(string_agg(r, ',' ORDER BY i) FILTER (WHERE c IS NOT NULL), '') AS found
          FROM (SELECT unnest({_PRICES}) AS r, generate_subscripts({_PRICES}, 1) AS i) x LEFT JOIN cols ON r = c),
steps AS (SELECT o_orderpriority AS e, lead(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) < o_orderdate AS back
          FROM orders),
mono AS (SELECT count(DISTINCT e) FILTER (WHERE back) AS k FROM steps)
SELECT 'has_date' AS rule, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, '' AS detail FROM cols WHERE c = 'date'
UNION ALL SELECT 'required_columns', CASE WHEN missing = '' THEN 'PASS' ELSE 'FAIL' END, missing FROM req
UNION ALL SELECT 'optional_columns', CASE WHEN missing = '' THEN 'PASS' ELSE 'WARN' END, missing FROM opt
UNION ALL SELECT 'any_column', CASE WHEN found <> '' THEN 'PASS' ELSE 'FAIL' END, found FROM price
UNION ALL SELECT 'numeric_types', CASE WHEN bad = '' THEN 'PASS' ELSE 'FAIL' END, bad FROM req
UNION ALL SELECT 'unique_key', CASE WHEN n = nd THEN 'PASS' ELSE 'FAIL' END, CAST(n - nd AS VARCHAR) FROM d
UNION ALL SELECT 'no_nulls', CASE WHEN k = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(k AS VARCHAR) FROM nulls
UNION ALL SELECT 'non_empty', CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END, CAST(n AS VARCHAR) FROM d
UNION ALL SELECT 'monotonic', CASE WHEN k = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(k AS VARCHAR) FROM mono""")
def q1_feature_store_validation(spark, sf_dir):
    """Validate the single-series feature store (no optional btc group):
    schema rules from the schema, data rules in one aggregate; the arrival
    order of the raw orders by their key (which does not follow the date)."""
    fs = _feature_store(spark, sf_dir).cache()
    static = QL.schema_rules(fs, _REQUIRED, _OPTIONAL, any_of=_PRICES)
    data = QL.evaluate(fs, QL.feature_store_rules(fs), static)
    orders = read_table(spark, sf_dir, "orders")
    return data.unionByName(QL.monotonic_rule(orders, "o_orderdate", "o_orderkey", ["o_orderpriority"]))


@register("q2_q6_readiness", ("P4", "P5"), f"""
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS "set" FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1),
j AS (SELECT date, gold, "set", CASE WHEN date >= DATE '2001-01-01' THEN gold END AS gold_roll7_mean
      FROM g FULL JOIN s USING (date)),
n AS (SELECT count(*) AS n, count(*) - count(gold) AS gold, count(*) - count("set") AS "set",
             count(*) - count(gold_roll7_mean) AS gold_roll7_mean FROM j),
l AS (UNPIVOT n ON gold, "set", gold_roll7_mean INTO NAME feature VALUE nulls)
SELECT feature, CASE WHEN nulls = n THEN 'ALL_NULL' WHEN nulls * 100.0 / n > 50 THEN 'HIGH_NULL' ELSE 'OK' END AS status,
  round(nulls * 100.0 / n * 1.000000000001, 4) + 0.0 AS null_pct FROM l
UNION ALL SELECT 'gold_pct_change', 'MISSING', NULL""")
def q2_q6_readiness(spark, sf_dir):
    """Readiness of expected features on a full-outer alignment whose
    rolling column arrives under its legacy name (renamed first)."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    g = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("gold"))
    s = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_extendedprice").alias("set"))
    j = g.join(s, "date", "full").withColumn(
        "gold_roll7", F.when(F.col("date") >= F.lit("2001-01-01").cast("date"), F.col("gold")))
    j = rename_legacy(j)
    r = QL.readiness(j, ["gold", "set", "gold_roll7_mean", "gold_pct_change"])
    return r.withColumn("null_pct", F.round(F.col("null_pct") * F.lit(1.000000000001), 4))


@register("q7_acceptance", ("Q7", "A4", "A11", "A12"), """
WITH g AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1, 2),
x AS (SELECT *, date - lag(date) OVER (PARTITION BY o_orderpriority ORDER BY date) AS gap FROM g),
a AS (SELECT count(*) AS n, stddev_samp(gold) AS sd, count(*) - count(gold) AS nulls,
      count(*) - count(DISTINCT (o_orderpriority, date)) AS dups, count(*) FILTER (WHERE gap > 7) AS gaps FROM x)
SELECT 'min_rows' AS rule, CASE WHEN n >= 500 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS VARCHAR) AS detail FROM a
UNION ALL SELECT 'min_std', CASE WHEN sd >= 1000 THEN 'PASS' ELSE 'FAIL' END, CAST(round(sd, 2) AS VARCHAR) FROM a
UNION ALL SELECT 'no_nulls', CASE WHEN nulls = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(nulls AS VARCHAR) FROM a
UNION ALL SELECT 'no_duplicates', CASE WHEN dups = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(dups AS VARCHAR) FROM a
UNION ALL SELECT 'few_gaps', CASE WHEN gaps <= 10 THEN 'PASS' ELSE 'FAIL' END, CAST(gaps AS VARCHAR) FROM a""")
def q7_acceptance(spark, sf_dir):
    return QL.acceptance_rules(gold_series(spark, sf_dir), "gold", "date", ["o_orderpriority"])


@register("q3_q12_health_summary", ("Q3", "Q5", "Q12", "F18"), """
WITH r AS (
SELECT CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS s FROM orders
UNION ALL SELECT CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM lineitem
UNION ALL SELECT CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM part
UNION ALL SELECT CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'WARN' END FROM information_schema.tables WHERE table_name = 'btc_feed'
UNION ALL SELECT CASE WHEN DATE '2001-08-03' - max(CAST(o_orderdate AS DATE)) <= 7 THEN 'PASS' ELSE 'WARN' END FROM orders)
SELECT count(*) FILTER (WHERE s = 'PASS') AS PASS, count(*) FILTER (WHERE s = 'WARN') AS WARN,
  count(*) FILTER (WHERE s = 'FAIL') AS FAIL,
  CASE WHEN count(*) FILTER (WHERE s = 'FAIL') > 0 THEN 'UNHEALTHY'
       WHEN count(*) FILTER (WHERE s = 'WARN') > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END AS overall FROM r""")
def q3_q12_health_summary(spark, sf_dir):
    """Presence of the raw sources (the optional one absent), feature-store
    freshness at a fixed as-of date, summarised by status."""
    tables = {"orders": read_table(spark, sf_dir, "orders"), "lineitem": read_table(spark, sf_dir, "lineitem"),
              "part": read_table(spark, sf_dir, "part"), "btc_feed": None}
    presence = QL.table_presence(spark, tables, ["orders", "lineitem", "part"])
    g = gold_series(spark, sf_dir, by_priority=False)
    age = F.datediff(F.lit("2001-08-03").cast("date"), F.max("date"))
    fresh = QL.evaluate(g, [QL.Rule("freshness", age <= 7, age.cast("string"), QL.WARN)])
    return QL.health_summary(presence.unionByName(fresh))
