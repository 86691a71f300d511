"""Registered queries: ordered window operators (W1-W19), as-of join
and the monitoring report (W12-W14, A22, F26-F29, Q11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import FeatureConfig, MonitorConfig
from ..operators import features as FT
from ..operators.align import asof_join, asof_join_split, calendar, ffill_distributed, fill, series_window
from ..operators.dedupe import dedupe
from ..operators.monitor import monitoring_report, moving_average_accuracy
from ..operators.split import chronological_split, contiguous_folds, series_checks
from ..operators.stats import tail_rows
from .feature_store import round_doubles
from .q_stats import GOLD, PRED, E, predictions
from .registry import register
from .series import gold_series, read_table
from .sqlgen import R

W = "OVER (PARTITION BY o_orderpriority ORDER BY date"


@register("w1_w5_series_features", ("W1", "W2", "W3", "W4", "W5"), f"""
WITH {GOLD}
SELECT o_orderpriority, date, {R('gold')} AS gold,
  {R(f'lag(gold, 1) {W})')} AS gold_lag1, {R(f'lag(gold, 3) {W})')} AS gold_lag3,
  {R(f'lead(gold, 1) {W})')} AS gold_next,
  {R(f'CASE WHEN count(gold) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 3 THEN avg(gold) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END')} AS gold_roll7_mean,
  {R(f'gold / NULLIF(lag(gold) {W}), 0) - 1', 6)} AS gold_pct_change,
  {R(f'gold - lag(gold) {W})')} AS gold_diff,
  date - lag(date) {W}) AS day_gap
FROM gold""")
def w1_w5_series_features(spark, sf_dir):
    g = gold_series(spark, sf_dir)
    cfg = FeatureConfig(entity=E)
    w = series_window(E)
    out = FT.add_features(g, cfg, ["gold"]).withColumns(
        {"gold_diff": FT.diff_col("gold", w), "day_gap": FT.day_gap_col("date", w)})
    out = out.withColumn("_pc", F.round(F.col("gold_pct_change") * F.lit(1.000000000001), 6))
    return round_doubles(out.drop("gold_pct_change"), skip=["_pc"]).withColumnRenamed("_pc", "gold_pct_change")


@register("p15_fill_zero_vector", ("P15", "T3", "W1", "W4"), f"""
WITH {GOLD}
SELECT o_orderpriority, date, {R('gold')} AS gold,
  {R(f'coalesce(lag(gold, 1) {W}), 0)')} AS gold_lag1, {R(f'coalesce(lag(gold, 3) {W}), 0)')} AS gold_lag3,
  {R(f'coalesce(gold / NULLIF(lag(gold) {W}), 0) - 1, 0)', 6)} AS gold_pct_change
FROM gold""")
def p15_fill_zero_vector(spark, sf_dir):
    """Scoring-API feature vectors: missing lags / changes become 0."""
    g = gold_series(spark, sf_dir)
    w = series_window(E)
    v = g.select(*E, "date", "gold", FT.lag_col("gold", 1, w).alias("gold_lag1"),
                 FT.lag_col("gold", 3, w).alias("gold_lag3"),
                 F.round(FT.pct_change_col("gold", w) * F.lit(1.000000000001), 6).alias("gold_pct_change"))
    return round_doubles(v.fillna(0), skip=["gold_pct_change"])


@register("w6_w8_fills", ("W6", "W7", "W8", "F15", "J1"), f"""
WITH {GOLD}, b AS (SELECT min(date) AS lo, max(date) AS hi FROM gold),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b),
cal AS (SELECT e.o_orderpriority, d.date FROM (SELECT DISTINCT o_orderpriority FROM gold) e, days d),
j AS (SELECT * FROM cal LEFT JOIN gold USING (o_orderpriority, date)),
f AS (SELECT o_orderpriority, date, gold,
  last_value(gold IGNORE NULLS) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff,
  first_value(gold IGNORE NULLS) {W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bf FROM j)
SELECT o_orderpriority, date, {R('ff')} AS gold_ffill, {R('coalesce(ff, bf)')} AS gold_ffill_bfill,
  {R('coalesce(ff, 0.0)')} AS gold_ffill_zero FROM f""")
def w6_w8_fills(spark, sf_dir):
    """Daily calendar per priority over the gold range; three fill modes."""
    g = gold_series(spark, sf_dir).cache()
    b = g.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    cal = calendar(spark, b["lo"], b["hi"], None, entities=g.select(*E).distinct())
    j = cal.join(g, [*E, "date"], "left")
    j = j.select(*E, "date", *[F.col("gold").alias(f"gold_{m}") for m in ("ffill", "ffill_bfill", "ffill_zero")])
    out = fill(j, ["gold_ffill"], E, backward=False)
    out = fill(out, ["gold_ffill_bfill"], E, backward=True)
    return round_doubles(fill(out, ["gold_ffill_zero"], E, backward=False, zero=True))


@register("w6_ffill_long_series", ("W6",), f"""
SELECT event_id, {R('last_value(CASE WHEN event_type = ' + "'purchase'" + ' THEN value END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS last_purchase
FROM events""")
def w6_ffill_long_series(spark, sf_dir):
    """The last purchase value as of every event - one series over the
    whole table (no entity), filled with the two-phase distributed fill."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    out = ffill_distributed(ev, ["last_purchase"], (), ("ts", "event_id"))
    return round_doubles(out.select("event_id", "last_purchase"))


@register("w7_fill_long_series", ("W7",), f"""
SELECT event_id, {R("coalesce(last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")} AS error_value
FROM events""")
def w7_fill_long_series(spark, sf_dir):
    """Forward then backward fill of the error events' value over the whole
    events table as one series (two-phase distributed fill)."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "error", F.col("value")).alias("error_value"))
    out = ffill_distributed(ev, ["error_value"], (), ("ts", "event_id"), backward=True)
    return round_doubles(out.select("event_id", "error_value"))


@register("w1_w4_long_series", ("W1", "W3", "W4"), f"""
SELECT event_id, {R('value')} AS value,
  {R('lag(value, 1) OVER (ORDER BY ts, event_id)')} AS value_lag1,
  {R('lag(value, 3) OVER (ORDER BY ts, event_id)')} AS value_lag3,
  {R('CASE WHEN count(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 3 THEN avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END')} AS value_roll7_mean,
  {R('value / NULLIF(lag(value) OVER (ORDER BY ts, event_id), 0) - 1', 6)} AS value_pct_change
FROM events""")
def w1_w4_long_series(spark, sf_dir):
    """Lags, rolling mean and change of one series spanning the whole events
    table (no entity), computed with halo rows across range partitions."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "value")
    out = FT.features_distributed(ev, ["value"], (), ("ts", "event_id"))
    out = out.withColumn("_pc", F.round(F.col("value_pct_change") * F.lit(1.000000000001), 6))
    return round_doubles(out.drop("ts", "value_pct_change"), skip=["_pc"]).withColumnRenamed("_pc", "value_pct_change")


@register("w9_dedupe_keep_last", ("W9", "S10"), f"""
SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type, {R('value')} AS value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
def w9_dedupe_keep_last(spark, sf_dir):
    """One event per (user, day): the latest by (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_id", "event_type", "value")
    return round_doubles(dedupe(ev, ["user_id", "day"], ["ts", "event_id"], keep="last"))


@register("w10_dedupe_keep_first", ("W10",), f"""
SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type, {R('value')} AS value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""")
def w10_dedupe_keep_first(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_id", "event_type", "value")
    return round_doubles(dedupe(ev, ["user_id", "day"], ["ts", "event_id"], keep="first"))


@register("w11_tail_per_user", ("W11", "T1"), f"""
SELECT user_id, ts, event_id, {R('value')} AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) <= 14""")
def w11_tail_per_user(spark, sf_dir):
    """Context of the last 14 events per user."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return round_doubles(tail_rows(ev, 14, ["user_id"], "ts"))


@register("w12_moving_accuracy", ("W12",), f"""
WITH {PRED}, m AS (SELECT o_orderpriority, date, 100 - abs((actual - predicted) / NULLIF(actual, 0)) * 100 AS acc FROM p)
SELECT o_orderpriority, date,
  {R(f'avg(acc) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 6)} AS MAcc_7d,
  {R(f'avg(acc) {W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)', 6)} AS MAcc_30d FROM m""")
def w12_moving_accuracy(spark, sf_dir):
    return round_doubles(moving_average_accuracy(predictions(spark, sf_dir), (7, 30), E), 6)


_REPORT_SQL = f"""
WITH {PRED},
m AS (SELECT o_orderpriority, date, 100 - abs((actual - predicted) / NULLIF(actual, 0)) * 100 AS acc FROM p),
mm AS (SELECT o_orderpriority, date,
  avg(acc) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
  avg(acc) {W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30 FROM m),
x AS (SELECT *, lag(m7) {W}) AS l7, lag(m30) {W}) AS l30,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY date DESC) AS rn,
  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM mm),
a AS (SELECT o_orderpriority, count(*) AS data_points, min(date) AS start, max(date) AS "end",
  max(CASE WHEN rn = 1 THEN m7 END) AS current_7d, max(CASE WHEN rn = 1 THEN m30 END) AS current_30d,
  CASE WHEN max(n) < 2 THEN 0.0 ELSE max(CASE WHEN rn = 2 THEN m7 END) - max(CASE WHEN rn = 1 THEN m7 END) END AS decay_rate_7d,
  CASE WHEN max(n) < 2 THEN 0.0 ELSE max(CASE WHEN rn = 2 THEN m30 END) - max(CASE WHEN rn = 1 THEN m30 END) END AS decay_rate_30d,
  coalesce(bool_and(CASE WHEN rn <= 4 THEN coalesce(m7 < l7, true) END), true) AS is_declining_7d,
  coalesce(bool_and(CASE WHEN rn <= 4 THEN coalesce(m30 < l30, true) END), true) AS is_declining_30d,
  var_samp(CASE WHEN rn <= 10 THEN m7 END) AS v,
  regr_slope(CASE WHEN rn <= 10 THEN m7 END, CASE WHEN rn <= 10 THEN n - rn END) AS s
  FROM x GROUP BY 1),
b AS (SELECT o_orderpriority, (count(*) FILTER (WHERE predicted > actual) - count(*) FILTER (WHERE predicted < actual))
  / count(*) AS balance_index FROM p GROUP BY 1),
r AS (SELECT *,
  decay_rate_7d < -0.5 OR is_declining_7d AS drift_detected_7d,
  decay_rate_30d < -0.5 OR is_declining_30d AS drift_detected_30d,
  CASE WHEN decay_rate_7d < -1.0 THEN 'HIGH' WHEN decay_rate_7d < -0.5 THEN 'MEDIUM' ELSE 'LOW' END AS severity_7d,
  CASE WHEN decay_rate_30d < -1.0 THEN 'HIGH' WHEN decay_rate_30d < -0.5 THEN 'MEDIUM' ELSE 'LOW' END AS severity_30d,
  CASE WHEN balance_index > 0.1 THEN 'OVER-PREDICT' WHEN balance_index < -0.1 THEN 'UNDER-PREDICT' ELSE 'BALANCED' END AS bias,
  CASE WHEN data_points < 10 THEN 'N/A' WHEN v < 0.1 THEN 'STABLE' WHEN v < 0.5 THEN 'MODERATE' ELSE 'VOLATILE' END AS speed,
  CASE WHEN data_points >= 10 THEN v END AS variance,
  CASE WHEN data_points >= 10 THEN (CASE WHEN s > 0 THEN 'IMPROVING' WHEN s < 0 THEN 'DECLINING' ELSE 'STABLE' END) END AS trend,
  CASE WHEN data_points >= 10 THEN s END AS slope
  FROM a JOIN b USING (o_orderpriority)),
k AS (SELECT *, list_filter([
  CASE WHEN drift_detected_7d THEN '⚠️  Concept drift detected (7d). Consider retraining the model.' END,
  CASE WHEN current_7d < 95 THEN '📉 Accuracy below 95%. Investigate feature quality.' END,
  CASE WHEN abs(balance_index) > 0.2 THEN '⚖️  Model is biased (' || bias || '). Check training data balance.' END,
  CASE WHEN speed = 'VOLATILE' THEN '📊 High volatility detected. Monitor closely for next few days.' END],
  lambda z: z IS NOT NULL) AS recs FROM r)
SELECT o_orderpriority, data_points, start, "end", {R('current_7d', 6)} AS current_7d, {R('current_30d', 6)} AS current_30d,
  {R('decay_rate_7d', 6)} AS decay_rate_7d, {R('decay_rate_30d', 6)} AS decay_rate_30d,
  is_declining_7d, is_declining_30d, drift_detected_7d, drift_detected_30d, severity_7d, severity_30d,
  {R('balance_index', 6)} AS balance_index, bias, speed, {R('variance', 6)} AS variance, trend, {R('slope', 6)} AS slope,
  CASE WHEN len(recs) > 0 THEN array_to_string(recs, ' | ') ELSE '✅ Model performance is stable.' END AS recommendations
FROM k"""


@register("q11_monitoring_report", ("Q11", "W12", "W13", "W14", "A7", "A9", "A22", "F26", "F27", "F28", "F29"),
          _REPORT_SQL)
def q11_monitoring_report(spark, sf_dir):
    rep = monitoring_report(predictions(spark, sf_dir), MonitorConfig(), E)
    rep = rep.withColumn("recommendations", F.array_join("recommendations", " | "))
    return round_doubles(rep, 6)


@register("w15_sequences", ("W15",), f"""
WITH {GOLD},
f AS (SELECT o_orderpriority, date, gold, lead(gold) {W}) AS gold_next, lag(gold, 1) {W}) AS gold_lag1,
        lag(gold, 3) {W}) AS gold_lag3,
        CASE WHEN count(gold) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 3
             THEN avg(gold) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS gold_roll7_mean,
        gold / NULLIF(lag(gold) {W}), 0) - 1 AS gold_pct_change FROM gold),
c AS (SELECT * FROM f WHERE gold_next IS NOT NULL AND gold_lag1 IS NOT NULL AND gold_lag3 IS NOT NULL
      AND gold_roll7_mean IS NOT NULL AND gold_pct_change IS NOT NULL),
s AS (SELECT o_orderpriority, date,
        list([{R('gold_lag1')}, {R('gold_lag3')}, {R('gold_roll7_mean')}, {R('gold')}])
          {W} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS sequence,
        {R('gold_next')} AS label FROM c)
SELECT * FROM s WHERE len(sequence) = 60""")
def w15_sequences(spark, sf_dir):
    """60-row samples of (gold, lags) per priority with the row's gold_next."""
    g = gold_series(spark, sf_dir)
    cfg = FeatureConfig(entity=E)
    f = FT.add_features(g, cfg, ["gold"]).dropna()
    seq = FT.sequences(f, ["gold_lag1", "gold_lag3", "gold_roll7_mean", "gold"], 60, "gold_next", E)
    nudge = F.lit(1.000000000001)
    return seq.select(*E, "date",
                      F.transform("sequence", lambda r: F.transform(r, lambda v: F.round(v * nudge, 4))).alias("sequence"),
                      F.round(F.col("label") * nudge, 4).alias("label"))


@register("w15_sequences_one_timeline", ("W15",), f"""
SELECT * FROM (SELECT ts, event_id, list([{R('value')}]) OVER (ORDER BY ts, event_id ROWS BETWEEN 60 PRECEDING
  AND 1 PRECEDING) AS sequence, {R('value')} AS label FROM events) WHERE len(sequence) = 60""")
def w15_sequences_one_timeline(spark, sf_dir):
    """The 60 values before each event, all events as one series, cut from
    ranges with a halo of 60 rows."""
    ev = read_table(spark, sf_dir, "events").select("ts", "event_id", "value")
    seq = FT.sequences_distributed(ev, ["value"], 60, order=("ts", "event_id"))
    nudge = F.lit(1.000000000001)
    return seq.select("ts", "event_id",
                      F.transform("sequence", lambda r: F.transform(r, lambda v: F.round(v * nudge, 4))).alias("sequence"),
                      F.round(F.col("label") * nudge, 4).alias("label"))


@register("w16_minmax_scale", ("W16",), f"""
WITH {GOLD}, s AS (SELECT o_orderpriority, min(gold) AS lo, max(gold) AS hi FROM gold GROUP BY 1)
SELECT o_orderpriority, date, {R('gold')} AS gold,
  {R('coalesce((gold - lo) / NULLIF(hi - lo, 0), 0.0)', 6)} AS gold_scaled FROM gold JOIN s USING (o_orderpriority)""")
def w16_minmax_scale(spark, sf_dir):
    out = FT.minmax_scale(gold_series(spark, sf_dir), ["gold"], E)
    return out.select(*E, "date", F.round(F.col("gold") * F.lit(1.000000000001), 4).alias("gold"),
                      F.round(F.col("gold_scaled") * F.lit(1.000000000001), 6).alias("gold_scaled"))


@register("w17_w18_split_folds", ("W17", "W18"), f"""
WITH {GOLD},
s AS (SELECT o_orderpriority, date, CASE WHEN row_number() {W}) <= count(*) OVER (PARTITION BY o_orderpriority)
  - ceil(0.2 * count(*) OVER (PARTITION BY o_orderpriority)) THEN 'train' ELSE 'test' END AS split FROM gold)
SELECT o_orderpriority, date, split, ntile(5) {W}) - 1 AS fold FROM s WHERE split = 'train'
UNION ALL SELECT o_orderpriority, date, split, NULL FROM s WHERE split = 'test'""")
def w17_w18_split_folds(spark, sf_dir):
    g = chronological_split(gold_series(spark, sf_dir), 0.2, E)
    train = contiguous_folds(g.filter(F.col("split") == "train"), 5, E)
    test = g.filter(F.col("split") == "test").withColumn("fold", F.lit(None).cast("int"))
    return train.unionByName(test).select(*E, "date", "split", "fold")


@register("w19_series_checks", ("W19", "A11"), """
SELECT user_id, coalesce(bool_and(coalesce(ts >= lag_ts, true)), true) AS monotonic,
  count(*) = count(DISTINCT ts) AS "unique", count(*) AS rows
FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS lag_ts FROM events)
GROUP BY 1""")
def w19_series_checks(spark, sf_dir):
    """Per user: are timestamps increasing in event-id order, and unique?"""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return series_checks(ev, "ts", "event_id", ["user_id"])


@register("j4_asof_join", ("J4",), f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS "set" FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, o.date, {R('s."set"')} AS "set" FROM o ASOF LEFT JOIN s ON o.date >= s.date""")
def j4_asof_join(spark, sf_dir):
    """Each order gets the last daily item price at or before its date."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    li = read_table(spark, sf_dir, "lineitem")
    s = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_extendedprice").alias("set"))
    return round_doubles(asof_join(o, s, ["set"]))


# Account 0 stands for seven users of ten, so it holds most events.
@register("j4_asof_hot_entity", ("J4",), f"""
WITH e AS (SELECT event_id, CASE WHEN user_id % 10 < 7 THEN 0 ELSE user_id END AS account, ts, event_type, value FROM events),
p AS (SELECT account, ts, max(value) AS last_purchase FROM e WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT e.event_id, e.account, {R('p.last_purchase')} AS last_purchase
FROM e ASOF LEFT JOIN p ON e.account = p.account AND e.ts >= p.ts""")
def j4_asof_hot_entity(spark, sf_dir):
    """Each event gets its account's last purchase at or before it; one account
    holds most events and is split over tasks."""
    ev = read_table(spark, sf_dir, "events").withColumn(
        "account", F.when(F.col("user_id") % 10 < 7, F.lit(0).cast("long")).otherwise(F.col("user_id")))
    bought = ev.where("event_type = 'purchase'").select("account", "ts", F.col("value").alias("last_purchase"))
    out = asof_join_split(ev.select("event_id", "account", "ts"), bought, ["last_purchase"], ["account"], "ts")
    return round_doubles(out.select("event_id", "account", "last_purchase"))


@register("j4_asof_one_timeline", ("J4",), f"""
WITH p AS (SELECT ts, max(value) AS last_error FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT e.event_id, e.event_type, {R('p.last_error')} AS last_error
FROM events e ASOF LEFT JOIN p ON e.ts >= p.ts""")
def j4_asof_one_timeline(spark, sf_dir):
    """Each event gets the last error at or before it, of any user: no entity."""
    ev = read_table(spark, sf_dir, "events")
    errors = ev.where("event_type = 'error'").select("ts", F.col("value").alias("last_error"))
    out = asof_join_split(ev.select("event_id", "event_type", "ts"), errors, ["last_error"], (), "ts")
    return round_doubles(out.select("event_id", "event_type", "last_error"))


@register("j5_actual_vs_predicted", ("J5",), f"""
WITH {PRED}, {GOLD.replace('gold AS', 'g2 AS')}
SELECT g2.o_orderpriority, g2.date, {R('g2.gold')} AS actual, {R('p.predicted')} AS predicted
FROM g2 LEFT JOIN p ON g2.o_orderpriority = p.o_orderpriority AND g2.date = p.date""")
def j5_actual_vs_predicted(spark, sf_dir):
    g = gold_series(spark, sf_dir).withColumnRenamed("gold", "actual")
    p = predictions(spark, sf_dir).select(*E, "date", "predicted")
    return round_doubles(g.join(p, [*E, "date"], "left"))

