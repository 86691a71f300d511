"""Registered queries: aggregations (A1-A26), sorts / top-k (K1-K8), unions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import stats as S
from ..operators.align import series_window
from ..operators.dedupe import duplicate_count, last_non_null_per_group
from .feature_store import round_doubles
from .registry import register
from .series import gold_series, lineitem_daily, oil_brand_series, read_table
from .sqlgen import R

E = ("o_orderpriority",)

GOLD = """gold AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold
  FROM orders GROUP BY 1, 2)"""
GOLD1 = """gold AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1)"""
W = "OVER (PARTITION BY o_orderpriority ORDER BY date"
TAIL = "tail AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY date DESC) AS rn FROM gold)"


def predictions(spark, sf_dir):
    """(entity, date, actual, predicted): actual = daily mean order price,
    predicted = naive mean of the previous 7 rows (needs 3), as M11."""
    g = gold_series(spark, sf_dir)
    w = series_window(E).rowsBetween(-7, -1)
    pred = F.when(F.count("gold").over(w) >= 3, F.avg("gold").over(w))
    return g.select(*E, "date", F.col("gold").alias("actual"), pred.alias("predicted")).dropna()


PRED = f"""{GOLD},
pred AS (SELECT o_orderpriority, date, gold AS actual,
  CASE WHEN count(gold) {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 3
       THEN avg(gold) {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS predicted FROM gold),
p AS (SELECT * FROM pred WHERE actual IS NOT NULL AND predicted IS NOT NULL)"""


@register("a1_group_mean", ("A1",), f"""
WITH oil_b AS (SELECT strftime(l_shipdate, '%Y-%m') AS period, p_brand,
  sum(l_extendedprice) / count(l_extendedprice) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT CAST(period || '-01' AS DATE) AS date, {R('avg(value)')} AS oil, count(*) AS series
FROM oil_b GROUP BY 1""")
def a1_group_mean(spark, sf_dir):
    b = oil_brand_series(spark, sf_dir)
    return round_doubles(b.groupBy("date").agg(F.avg("value").alias("oil"), F.count(F.lit(1)).alias("series")))


@register("a2_last_tick_per_day", ("A2", "K2"), f"""
WITH t AS (SELECT event_type, CAST(ts AS DATE) AS day, ts, event_id,
  value, CASE WHEN user_id % 3 = 0 THEN NULL ELSE value END AS value_sparse FROM events)
SELECT event_type, day,
  {R('arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL)')} AS value,
  {R('arg_max(value_sparse, (ts, event_id)) FILTER (WHERE value_sparse IS NOT NULL)')} AS value_sparse
FROM t GROUP BY 1, 2""")
def a2_last_tick_per_day(spark, sf_dir):
    """Last non-null value per (event type, day), column by column; a sparse
    copy of the value (NULL for a third of users) shows the per-column skip."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_type", F.to_date("ts").alias("day"), "ts", "event_id", "value",
        F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("value_sparse"))
    return round_doubles(last_non_null_per_group(ev, ["event_type", "day"], ["ts", "event_id"],
                                                 ["value", "value_sparse"]))


@register("a3_date_bounds", ("A3",), """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders UNION ALL
           SELECT CAST(l_shipdate AS DATE) FROM lineitem)
SELECT min(date) AS lo, max(date) AS hi FROM d""")
def a3_date_bounds(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    li = read_table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    parts = [x.agg(F.min("date").alias("lo"), F.max("date").alias("hi")) for x in (o, li)]
    return parts[0].unionByName(parts[1]).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@register("a4_descriptive_stats", ("A4", "W5"), f"""
WITH {GOLD}, d AS (SELECT *, gold - lag(gold) {W}) AS diff FROM gold)
SELECT o_orderpriority, count(gold) AS count, {R('min(gold)')} AS min, {R('max(gold)')} AS max,
  {R('avg(gold)')} AS mean, {R('median(gold)')} AS median, {R('stddev_samp(gold)')} AS std,
  count(DISTINCT gold) AS "unique", {R('avg(diff)')} AS mean_daily_diff
FROM d GROUP BY 1""")
def a4_descriptive_stats(spark, sf_dir):
    return round_doubles(S.descriptive_stats(gold_series(spark, sf_dir), "gold", E))


@register("a5_trailing_metrics", ("A5", "W11"), f"""
WITH {GOLD}, {TAIL}, t AS (SELECT * FROM tail WHERE rn <= 30),
a AS (SELECT o_orderpriority, arg_max(gold, date) AS current, arg_min(gold, date) AS first,
  min(gold) AS mn, max(gold) AS mx, avg(gold) AS av, stddev_samp(gold) AS sd FROM t GROUP BY 1)
SELECT o_orderpriority, {R('current')} AS current, {R('mn')} AS min, {R('mx')} AS max, {R('av')} AS avg,
  {R('sd')} AS std, {R('current - first')} AS change, {R('(current - first) / NULLIF(first, 0) * 100')} AS change_pct,
  {R('sd / NULLIF(av, 0) * 100')} AS volatility
FROM a""")
def a5_trailing_metrics(spark, sf_dir):
    return round_doubles(S.trailing_metrics(gold_series(spark, sf_dir), "gold", 30, E))


@register("a6_tail_correlations", ("A6", "K7", "W11"), f"""
WITH {GOLD1}, d AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS "set",
  sum(l_quantity) AS qty, avg(l_discount) AS disc, avg(l_tax) AS tax FROM lineitem GROUP BY 1),
j AS (SELECT * FROM gold JOIN d USING (date)),
t AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS rn FROM j) WHERE rn <= 180),
c AS (SELECT corr(gold, "set") AS "set", corr(gold, qty) AS qty, corr(gold, disc) AS disc,
             corr(gold, tax) AS tax FROM t),
l AS (UNPIVOT c ON "set", qty, disc, tax INTO NAME variable VALUE corr)
SELECT variable, {R('corr', 6)} AS corr,
  row_number() OVER (ORDER BY corr DESC NULLS LAST, variable) AS rank FROM l""")
def a6_tail_correlations(spark, sf_dir):
    g = gold_series(spark, sf_dir, by_priority=False)
    d = lineitem_daily(spark, sf_dir).select(
        "date", (F.col("s_ext") / F.col("n_ext")).alias("set"), F.col("btc").alias("qty"),
        (F.col("s_disc") / F.col("n_disc")).alias("disc"), (F.col("s_tax") / F.col("n_tax")).alias("tax"))
    j = g.join(d, "date")
    return round_doubles(S.tail_correlations(j, "gold", ["set", "qty", "disc", "tax"], 180), 6)


@register("a7_tail_slope", ("A7", "W11"), f"""
WITH {GOLD}, {TAIL}, t AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority) - rn AS x
  FROM tail WHERE rn <= 7)
SELECT o_orderpriority, {R('regr_slope(gold, x)')} AS slope FROM t GROUP BY 1""")
def a7_tail_slope(spark, sf_dir):
    return round_doubles(S.tail_slope(gold_series(spark, sf_dir), "gold", 7, E))


@register("a8_tail_mean_pct_change", ("A8", "W4", "W11"), f"""
WITH {GOLD}, {TAIL}, t AS (SELECT * FROM tail WHERE rn <= 7),
p AS (SELECT o_orderpriority, gold / NULLIF(lag(gold) {W}), 0) - 1 AS pc FROM t)
SELECT o_orderpriority, {R('avg(pc) * 100', 6)} AS avg_change_pct FROM p GROUP BY 1""")
def a8_tail_mean_pct_change(spark, sf_dir):
    return round_doubles(S.tail_mean_pct_change(gold_series(spark, sf_dir), "gold", 7, E), 6)


@register("a9_tail_variance", ("A9", "W11"), f"""
WITH {GOLD}, {TAIL}
SELECT o_orderpriority, {R('var_samp(gold)', 2)} AS variance FROM tail WHERE rn <= 10 GROUP BY 1""")
def a9_tail_variance(spark, sf_dir):
    return round_doubles(S.tail_variance(gold_series(spark, sf_dir), "gold", 10, E), 2)


@register("a10_null_report", ("J2",), """
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS "set" FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1),
q AS (SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS qty FROM lineitem
      WHERE l_linestatus = 'O' GROUP BY 1),
j AS (SELECT * FROM g FULL JOIN s USING (date) FULL JOIN q USING (date)),
n AS (SELECT count(*) AS n, count(*) - count(date) AS date, count(*) - count(gold) AS gold,
             count(*) - count("set") AS "set", count(*) - count(qty) AS qty FROM j),
l AS (UNPIVOT n ON date, gold, "set", qty INTO NAME "column" VALUE nulls)
SELECT "column", nulls, round(nulls * 100.0 / n * 1.000000000001, 4) + 0.0 AS null_pct
FROM l WHERE nulls > 0 ORDER BY nulls DESC, "column" LIMIT 10""")
def a10_null_report(spark, sf_dir):
    """NULL report of a full-outer alignment of three filtered series."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    g = o.filter(F.col("o_orderstatus") == "F").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.avg("o_totalprice").alias("gold"))
    s = li.filter(F.col("l_returnflag") == "R").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.avg("l_extendedprice").alias("set"))
    q = li.filter(F.col("l_linestatus") == "O").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("qty"))
    j = g.join(s, "date", "full").join(q, "date", "full")
    rep = S.null_report(j, ["date", "gold", "set", "qty"])
    return rep.withColumn("null_pct", F.round(F.col("null_pct") * F.lit(1.000000000001), 4))


@register("a11_duplicate_count", ("A11",), """
SELECT count(*) - count(DISTINCT (user_id, CAST(ts AS DATE))) AS duplicates FROM events""")
def a11_duplicate_count(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return duplicate_count(ev, ["user_id", "day"])


@register("a12_gap_count", ("A12", "W5"), """
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders),
g AS (SELECT o_custkey, date - lag(date) OVER (PARTITION BY o_custkey ORDER BY date) AS gap FROM d)
SELECT o_custkey, count(*) FILTER (WHERE gap > 7) AS gaps FROM g GROUP BY 1""")
def a12_gap_count(spark, sf_dir):
    """Steps of more than 7 days between consecutive orders, per customer."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return S.gap_count(o, 7, ["o_custkey"])


@register("a13_measurement_summary", ("A13", "A14"), f"""
SELECT event_type, {R('avg(value)')} AS mean, {R('stddev_pop(value)')} AS std, count(value) AS n,
  {R('quantile_cont(value, 0.5)')} AS p50, {R('quantile_cont(value, 0.95)')} AS p95,
  {R('quantile_cont(value, 0.99)')} AS p99,
  {R('1000.0 / avg(value)')} AS throughput_per_s
FROM events GROUP BY 1""")
def a13_measurement_summary(spark, sf_dir):
    """events.value as a latency measurement per event type: mean, population
    std, exact p50/p95/p99 (distributed ranks) and throughput = 1000 / mean."""
    ev = read_table(spark, sf_dir, "events")
    out = S.measurement_summary(ev, "value", ["event_type"])
    return round_doubles(out.withColumn("throughput_per_s", 1000.0 / F.col("mean")))


@register("a15_regression_metrics", ("A15", "M11"), f"""
WITH {PRED},
a AS (SELECT o_orderpriority, avg(abs(actual - predicted)) AS mae, avg((actual - predicted) ^ 2) AS mse,
  sum((actual - predicted) ^ 2) AS sse, var_pop(actual) * count(*) AS sst,
  avg(abs((actual - predicted) / NULLIF(actual, 0))) * 100 AS mape FROM p GROUP BY 1)
SELECT o_orderpriority, {R('mae')} AS mae, {R('mse', 2)} AS mse, {R('sqrt(mse)')} AS rmse,
  {R('CASE WHEN sst = 0 AND sse = 0 THEN 1.0 ELSE 1 - sse / NULLIF(sst, 0) END', 6)} AS r2,
  {R('mape', 6)} AS mape, {R('100 - mape', 6)} AS accuracy FROM a""")
def a15_regression_metrics(spark, sf_dir):
    """Naive 7-row-mean baseline scored against the actual daily price."""
    m = S.regression_metrics(predictions(spark, sf_dir), entity=E)
    return m.select(*E, *[F.round(F.col(c) * F.lit(1.000000000001), d).alias(c) for c, d in
                          [("mae", 4), ("mse", 2), ("rmse", 4), ("r2", 6), ("mape", 6), ("accuracy", 6)]])


@register("a16_iqr_outliers", ("A16", "A18"), f"""
WITH {GOLD},
q AS (SELECT o_orderpriority, quantile_cont(gold, 0.25) AS q1, quantile_cont(gold, 0.75) AS q3,
      count(gold) AS cnt FROM gold GROUP BY 1)
SELECT o_orderpriority, count(*) FILTER (WHERE cnt > 10 AND (gold < q1 - 3 * (q3 - q1) OR gold > q3 + 3 * (q3 - q1)))
  AS outliers, count(*) AS rows FROM gold JOIN q USING (o_orderpriority) GROUP BY 1""")
def a16_iqr_outliers(spark, sf_dir):
    f = S.outlier_flags(gold_series(spark, sf_dir), "gold", E, "iqr", 3.0, 10)
    return f.groupBy(*E).agg(F.count_if("is_outlier").alias("outliers"), F.count(F.lit(1)).alias("rows"))


@register("a17_zscore_outliers", ("A17", "A18"), f"""
WITH d AS (SELECT o_custkey, o_totalprice AS v FROM orders),
s AS (SELECT o_custkey, avg(v) AS mu, stddev_samp(v) AS sd, count(v) AS cnt FROM d GROUP BY 1)
SELECT o_custkey, count(*) FILTER (WHERE cnt > 10 AND abs((v - mu) / NULLIF(sd, 0)) > 2) AS outliers,
  count(*) AS rows FROM d JOIN s USING (o_custkey) GROUP BY 1""")
def a17_zscore_outliers(spark, sf_dir):
    """Order prices more than 2 sample std from their customer's mean
    (customers with more than 10 orders only)."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.col("o_totalprice").alias("v"))
    f = S.outlier_flags(o, "v", ["o_custkey"], "zscore", 2.0, 10)
    return f.groupBy("o_custkey").agg(F.count_if("is_outlier").alias("outliers"), F.count(F.lit(1)).alias("rows"))


BRAND_REV = """rev AS (SELECT p_brand AS feature, sum(l_extendedprice * (1 - l_discount)) AS importance
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)"""


def _brand_revenue(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    pre = li.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    return (pre.join(part, pre["l_partkey"] == part["p_partkey"])
            .groupBy(F.col("p_brand").alias("feature")).agg(F.sum("r").alias("importance")))


@register("a19_share_of_total", ("A19", "K4"), f"""
WITH {BRAND_REV}
SELECT feature, {R('importance', 2)} AS importance,
  {R('importance / sum(importance) OVER () * 100', 6)} AS importance_pct FROM rev""")
def a19_share_of_total(spark, sf_dir):
    """Revenue share per brand (an aggregated, bounded table)."""
    s = S.share_of_total(_brand_revenue(spark, sf_dir), "importance", "importance_pct")
    return s.select("feature", F.round(F.col("importance") * F.lit(1.000000000001), 2).alias("importance"),
                    F.round(F.col("importance_pct") * F.lit(1.000000000001), 6).alias("importance_pct"))


@register("a20_prefix_group_sums", ("A20",), f"""
WITH {BRAND_REV},
g AS (SELECT regexp_extract(feature, '^(Brand#1|Brand#2|Brand#3)', 1) AS "group", importance FROM rev)
SELECT "group", {R('sum(importance)', 2)} AS importance, count(*) AS features FROM g
WHERE "group" <> '' GROUP BY 1""")
def a20_prefix_group_sums(spark, sf_dir):
    out = S.prefix_group_sums(_brand_revenue(spark, sf_dir), "feature", "importance",
                              ["Brand#1", "Brand#2", "Brand#3"])
    return out.select("group", F.round(F.col("importance") * F.lit(1.000000000001), 2).alias("importance"),
                      "features")


@register("a21_top_share", ("A21", "K4", "A19"), f"""
WITH {BRAND_REV}, s AS (SELECT feature, importance / sum(importance) OVER () * 100 AS pct FROM rev)
SELECT {R('sum(pct)', 6)} AS top10_importance_pct FROM (SELECT * FROM s ORDER BY pct DESC LIMIT 10)""")
def a21_top_share(spark, sf_dir):
    s = S.share_of_total(_brand_revenue(spark, sf_dir), "importance", "importance_pct")
    out = S.top_share(s, "importance_pct", 10)
    return out.select(F.round(F.col("top10_importance_pct") * F.lit(1.000000000001), 6).alias("top10_importance_pct"))


@register("a22_balance_index", ("A22",), f"""
WITH {PRED}
SELECT o_orderpriority, {R('(count(*) FILTER (WHERE predicted > actual) - count(*) FILTER (WHERE predicted < actual))'
                          ' / count(*)', 6)} AS balance_index FROM p GROUP BY 1""")
def a22_balance_index(spark, sf_dir):
    return round_doubles(S.balance_index(predictions(spark, sf_dir), entity=E), 6)


@register("a23_uptime", ("A23",), """
SELECT round(coalesce(avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) * 100, 100)
       * 1.000000000001, 4) + 0.0 AS uptime_pct, count(*) AS checks
FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 24 HOURS
  AND ts <= TIMESTAMP '2024-01-15 00:00:00'""")
def a23_uptime(spark, sf_dir):
    """events as a check log: healthy unless the event is an error."""
    ev = read_table(spark, sf_dir, "events")
    return round_doubles(S.uptime_pct(ev, "ts", F.col("event_type") != "error", "2024-01-15 00:00:00", 24))


@register("a24_range_report", ("A24",), f"""
WITH {GOLD}
SELECT o_orderpriority, count(*) AS rows, min(date) AS start, max(date) AS "end",
  {R('arg_max(gold, date)')} AS latest FROM gold GROUP BY 1""")
def a24_range_report(spark, sf_dir):
    return round_doubles(S.range_report(gold_series(spark, sf_dir), "date", "gold", E))


@register("a26_first_last_diff", ("A26", "W11"), f"""
WITH {GOLD}, {TAIL}
SELECT o_orderpriority, {R('arg_max(gold, date) - arg_min(gold, date)')} AS diff
FROM tail WHERE rn <= 30 GROUP BY 1""")
def a26_first_last_diff(spark, sf_dir):
    return round_doubles(S.first_last_diff(gold_series(spark, sf_dir), "gold", 30, E))


# ------------------------------------------------------------ sorts / top-k

@register("k3_head_tail", ("K1", "K3"), f"""
WITH {GOLD1}
(SELECT 'head' AS part, date, {R('gold')} AS gold FROM gold ORDER BY date LIMIT 10)
UNION ALL
(SELECT 'tail' AS part, date, {R('gold')} AS gold FROM gold ORDER BY date DESC LIMIT 10)""")
def k3_head_tail(spark, sf_dir):
    g = gold_series(spark, sf_dir, by_priority=False)
    head = g.orderBy("date").limit(10).withColumn("part", F.lit("head"))
    tail = g.orderBy(F.col("date").desc()).limit(10).withColumn("part", F.lit("tail"))
    return round_doubles(head.unionByName(tail).select("part", "date", "gold"))


@register("k5_model_ranking", ("K5",), f"""
WITH {PRED},
m AS (SELECT 'naive7' AS model, avg(abs(actual - predicted)) AS mae FROM p
      UNION ALL SELECT 'last_value', avg(abs(gold - prev)) FROM
        (SELECT gold, lag(gold) {W}) AS prev FROM gold) WHERE prev IS NOT NULL)
SELECT model, {R('mae')} AS mae, row_number() OVER (ORDER BY mae, model) AS rank,
  first_value(model) OVER (ORDER BY mae, model) AS best FROM m""")
def k5_model_ranking(spark, sf_dir):
    """Rank two baselines by MAE and name the argmin."""
    p = predictions(spark, sf_dir)
    naive = p.agg(F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae")).withColumn("model", F.lit("naive7"))
    g = gold_series(spark, sf_dir)
    last = (g.withColumn("prev", F.lag("gold").over(series_window(E))).filter(F.col("prev").isNotNull())
            .agg(F.avg(F.abs(F.col("gold") - F.col("prev"))).alias("mae")).withColumn("model", F.lit("last_value")))
    m = naive.unionByName(last)
    w = Window.orderBy("mae", "model")   # two rows: a bounded, single-partition ranking
    out = m.withColumn("rank", F.row_number().over(w)).withColumn("best", F.first("model").over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return round_doubles(out.select("model", "mae", "rank", "best"))


@register("k6_latest_row", ("K6",), f"""
WITH {GOLD}
SELECT o_orderpriority, max(date) AS date, {R('arg_max(gold, date)')} AS gold FROM gold GROUP BY 1""")
def k6_latest_row(spark, sf_dir):
    g = gold_series(spark, sf_dir)
    latest = g.groupBy(*E).agg(F.max_by(F.struct("date", "gold"), "date").alias("r"))
    return round_doubles(latest.select(*E, "r.date", "r.gold"))


@register("k8_seeded_sample", ("K8",), f"""
SELECT o_orderkey, o_custkey, {R('o_totalprice', 2)} AS o_totalprice FROM orders
ORDER BY ((o_orderkey % 4294967296) * 40503 + 42 * 69069) % 4294967296, o_orderkey LIMIT 50""")
def k8_seeded_sample(spark, sf_dir):
    """50 orders chosen by a seeded multiplicative hash of the key: the same
    rows whatever the partitioning (a top-k by hash, not a fraction sample)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    top = o.orderBy(S.seeded_hash("o_orderkey", 42), "o_orderkey").limit(50)
    return round_doubles(top, 2)


# ------------------------------------------------------------------ unions

@register("u1_union_by_name", ("U1", "U2", "P7"), f"""
WITH a AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold, count(*) AS n FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders
      WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT date, {R('gold')} AS gold, n, 'F' AS src FROM a UNION ALL
SELECT date, {R('gold')} AS gold, CAST(NULL AS BIGINT) AS n, 'O' AS src FROM b""")
def u1_union_by_name(spark, sf_dir):
    """Union of two tables with different columns; missing ones become NULL."""
    o = read_table(spark, sf_dir, "orders")
    a = (o.filter(F.col("o_orderstatus") == "F").groupBy(F.to_date("o_orderdate").alias("date"))
         .agg(F.avg("o_totalprice").alias("gold"), F.count(F.lit(1)).alias("n")).withColumn("src", F.lit("F")))
    b = (o.filter(F.col("o_orderstatus") != "F").groupBy(F.to_date("o_orderdate").alias("date"))
         .agg(F.avg("o_totalprice").alias("gold")).withColumn("src", F.lit("O")))
    return round_doubles(a.unionByName(b, allowMissingColumns=True))
