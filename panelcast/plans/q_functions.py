"""Registered queries: scalar functions (F1-F30) on raw strings synthesised
from the given tables, so every parse runs over whole tables and the
expected value is known (round trips must be identities)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions import numbers as N
from .q_stats import PRED
from .registry import register
from .series import gold_series, read_table
from .sqlgen import R

THAI_LIST = "['มกราคม', 'กุมภาพันธ์', 'มีนาคม', 'เมษายน', 'พฤษภาคม', 'มิถุนายน', " \
            "'กรกฎาคม', 'สิงหาคม', 'กันยายน', 'ตุลาคม', 'พฤศจิกายน', 'ธันวาคม']"


@register("f1_be_slash_dates", ("F1", "D1"), """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%Y')
       ELSE strftime(o_orderdate, '%d/%m/') || lpad(CAST(year(o_orderdate) + 543 AS VARCHAR), 4, '0') END AS raw,
  CAST(o_orderdate AS DATE) AS parsed FROM orders""")
def f1_be_slash_dates(spark, sf_dir):
    """Orders' dates written as dd/mm/yyyy - Common era for open orders,
    Buddhist era otherwise - parsed back."""
    o = read_table(spark, sf_dir, "orders")
    ce = F.date_format("o_orderdate", "dd/MM/yyyy")
    raw = F.when(F.col("o_orderstatus") == "O", ce).otherwise(D.to_be_slash(F.to_date("o_orderdate")))
    return o.select("o_orderkey", raw.alias("raw")).withColumn("parsed", D.parse_be_slash_date("raw"))


@register("f2_thai_long_dates", ("F2",), f"""
SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) || ' ' || {THAI_LIST}[month(o_orderdate)] || ' '
  || CAST(year(o_orderdate) + 543 AS VARCHAR) AS raw, CAST(o_orderdate AS DATE) AS parsed FROM orders""")
def f2_thai_long_dates(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return (o.select("o_orderkey", D.to_thai_long(F.to_date("o_orderdate")).alias("raw"))
            .withColumn("parsed", D.parse_thai_long_date("raw")))


@register("f3_fallback_dates", ("F3", "Q8"), """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN lpad(CAST(year(l_shipdate) + 543 AS VARCHAR), 4, '0') || strftime(l_shipdate, '-%m-%d %H:%M:%S')
       WHEN l_returnflag = 'A' THEN strftime(l_shipdate, '%Y/%m/%d')
       ELSE strftime(l_shipdate, '%d/%m/') || CAST(year(l_shipdate) + 543 AS VARCHAR) END AS raw,
  CAST(l_shipdate AS DATE) AS parsed FROM lineitem""")
def f3_fallback_dates(spark, sf_dir):
    """Three raw formats in one column (BE ISO timestamp, yyyy/MM/dd, BE
    slash date) resolved by the F1 -> F2 -> F3 chain."""
    li = read_table(spark, sf_dir, "lineitem")
    d = F.to_date("l_shipdate")
    be_iso = F.concat(F.lpad((F.year(d) + 543).cast("string"), 4, "0"),
                      F.date_format("l_shipdate", "-MM-dd HH:mm:ss"))
    raw = (F.when(F.col("l_returnflag") == "R", be_iso)
           .when(F.col("l_returnflag") == "A", F.date_format("l_shipdate", "yyyy/MM/dd"))
           .otherwise(D.to_be_slash(d)))
    return D.with_parsed_date(li.select("l_orderkey", "l_linenumber", raw.alias("raw")), "raw", "parsed")


@register("f4_f6_times", ("F4", "F5", "F6"), """
SELECT event_id, 'เวลา ' || strftime(ts, '%H:%M') || ' น.' AS raw_time,
  strftime(ts, '%H:%M') || ':00' AS time,
  'updated ' || strftime(ts, '%d/%m/') || CAST(year(ts) + 543 AS VARCHAR) || ' by feed' AS raw_text,
  strftime(ts, '%d/%m/') || CAST(year(ts) + 543 AS VARCHAR) AS date_text,
  CAST(date_trunc('minute', ts) AS TIMESTAMP) AS datetime FROM events""")
def f4_f6_times(spark, sf_dir):
    """Thai time text -> HH:MM:00 (F4), date found inside a text (F5),
    date + time assembled into a timestamp (F6)."""
    ev = read_table(spark, sf_dir, "events")
    raw_time = F.concat(F.lit("เวลา "), F.date_format("ts", "HH:mm"), F.lit(" น."))
    raw_text = F.concat(F.lit("updated "), D.to_be_slash(F.to_date("ts")), F.lit(" by feed"))
    out = ev.select("event_id", raw_time.alias("raw_time"), raw_text.alias("raw_text"))
    out = out.withColumns({"time": D.normalize_time("raw_time"), "date_text": D.extract_slash_date("raw_text")})
    return out.withColumn("datetime", D.assemble_datetime(D.parse_be_slash_date("date_text"), F.col("time"),
                                                          now=F.lit(None)))


@register("f7_f9_numbers", ("F7", "F8", "F9", "D1"), f"""
SELECT o_orderkey, format('{{:,.2f}}', o_totalprice) AS raw_comma,
  '฿' || format('{{:,.2f}}', o_totalprice) || ' บาท' AS raw_currency,
  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS raw_mixed,
  {R('o_totalprice', 2)} AS comma_value, {R('o_totalprice', 2)} AS currency_value,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS mixed_value FROM orders""")
def f7_f9_numbers(spark, sf_dir):
    """Comma-grouped prices (F7), prices with currency noise (F8) and a
    mixed text column coerced to DOUBLE (F9)."""
    o = read_table(spark, sf_dir, "orders")
    raw_comma = F.format_number("o_totalprice", 2)
    raw_cur = F.concat(F.lit("฿"), raw_comma, F.lit(" บาท"))
    mixed = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    out = o.select("o_orderkey", raw_comma.alias("raw_comma"), raw_cur.alias("raw_currency"), mixed.alias("raw_mixed"))
    out = out.withColumns({"comma_value": N.strip_thousands("raw_comma"),
                           "currency_value": N.clean_numeric("raw_currency"),
                           "mixed_value": N.to_number("raw_mixed")})
    return out.withColumns({c: F.round(F.col(c) * F.lit(1.000000000001), 2) for c in ("comma_value", "currency_value")})


@register("f10_f13_calendar_strings", ("F10", "F11", "F12", "F13"), """
SELECT event_id, strftime(ts, '%Y-%m') AS period, CAST(strftime(ts, '%Y-%m') || '-01' AS DATE) AS month_start,
  strftime(ts, '%m/%d/%Y') AS us_text, CAST(ts AS DATE) AS us_date,
  CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS epoch_ms, CAST(ts AS DATE) AS epoch_date, strftime(ts, '%Y-%m-%d') AS iso FROM events""")
def f10_f13_calendar_strings(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    out = ev.select("event_id", F.date_format("ts", "yyyy-MM").alias("period"),
                    F.date_format("ts", "MM/dd/yyyy").alias("us_text"),
                    F.unix_micros(F.col("ts").cast("timestamp")).alias("_us"), F.to_date("ts").alias("_d"))
    out = out.withColumn("epoch_ms", F.floor(F.col("_us") / 1000).cast("long"))
    return out.select("event_id", "period", D.month_start("period").alias("month_start"), "us_text",
                      D.parse_date("us_text").alias("us_date"), "epoch_ms",
                      D.epoch_ms_to_date("epoch_ms").alias("epoch_date"), D.date_to_iso("_d").alias("iso"))


@register("f14_f17_weekdays", ("F14", "F16", "F17"), """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
SELECT date, dayname(date) AS day_name, isodow(date) - 1 AS weekday,
  isodow(date) <> 7 AS is_open, CASE WHEN isodow(date) = 6 THEN date + 2 ELSE date + 1 END AS next_open,
  CASE WHEN isodow(date) = 5 THEN date + 3 WHEN isodow(date) = 6 THEN date + 2 ELSE date + 1 END AS next_weekday
FROM d""")
def f14_f17_weekdays(spark, sf_dir):
    """Weekday name/number, open-day flag with Sunday closed, next open day
    (Sunday closed) and next weekday (Saturday and Sunday closed)."""
    d = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return d.select("date", D.weekday_name("date").alias("day_name"), D.weekday_number("date").alias("weekday"),
                    D.is_open_day("date", [6]).alias("is_open"), D.next_open_day("date", [6]).alias("next_open"),
                    D.next_open_day("date", [5, 6]).alias("next_weekday"))


@register("f18_age_days", ("F18", "Q5"), """
WITH g AS (SELECT o_orderpriority, max(CAST(o_orderdate AS DATE)) AS latest FROM orders GROUP BY 1)
SELECT o_orderpriority, latest, DATE '2001-08-10' - latest AS age_days,
  CASE WHEN DATE '2001-08-10' - latest > 7 THEN 'stale' WHEN DATE '2001-08-10' - latest > 3 THEN 'aging'
       ELSE 'fresh' END AS freshness FROM g""")
def f18_age_days(spark, sf_dir):
    """Days since each priority's latest order at a fixed as-of date, with
    the freshness bands (>7 stale, >3 aging)."""
    g = gold_series(spark, sf_dir).groupBy("o_orderpriority").agg(F.max("date").alias("latest"))
    age = D.age_days("latest", F.lit("2001-08-10").cast("date"))
    return g.select("o_orderpriority", "latest", age.alias("age_days")).withColumn(
        "freshness", F.when(F.col("age_days") > 7, "stale").when(F.col("age_days") > 3, "aging").otherwise("fresh"))


def B(x: str) -> str:
    """Oracle side of ``bround(x * nudge, 2)``."""
    return f"(round_even(({x}) * 1.000000000001, 2) + 0.0)"


@register("f20_f21_changes", ("F20", "F21", "F24"), f"""
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1),
c AS (SELECT date, gold, lag(gold) OVER (ORDER BY date) AS last FROM g)
SELECT date, {B('gold')} AS price, {B('gold - last')} AS change,
  {B('(gold - last) / NULLIF(last, 0) * 100')} AS change_pct,
  CASE WHEN (gold - last) / NULLIF(last, 0) * 100 IS NULL THEN NULL
       WHEN abs((gold - last) / NULLIF(last, 0) * 100) < 0.5 THEN 'flat'
       WHEN (gold - last) / NULLIF(last, 0) * 100 > 0 THEN 'up' ELSE 'down' END AS direction FROM c""")
def f20_f21_changes(spark, sf_dir):
    """Change, change % (NULL when the previous value is 0), half-even
    rounding to 2 decimals and the direction class."""
    from pyspark.sql import Window
    g = gold_series(spark, sf_dir, by_priority=False)
    last = F.lag("gold").over(Window.orderBy("date"))   # one row per day: bounded by the calendar
    c = g.withColumn("last", last)
    pct = N.change_pct("gold", "last")
    # Averages of cent amounts are often exact ties at 2 decimals and can
    # differ by one ulp between engines; the nudge makes the check stable.
    nudge = F.lit(1.000000000001)
    return c.select("date", N.round2(F.col("gold") * nudge).alias("price"),
                    N.round2(N.change("gold", "last") * nudge).alias("change"),
                    N.round2(pct * nudge).alias("change_pct"), L.direction_class(pct).alias("direction"))


@register("f23_f25_dashboard_classes", ("F23", "F25", "A5", "A8", "Q13"), f"""
WITH g AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY date DESC) AS rn FROM g),
t30 AS (SELECT o_orderpriority, arg_max(gold, date) AS cur, arg_min(gold, date) AS first,
        stddev_samp(gold) / avg(gold) * 100 AS volatility, max(date) AS latest_date FROM t WHERE rn <= 30 GROUP BY 1),
t7 AS (SELECT o_orderpriority, avg(pc) * 100 AS avg_change_7d_pct FROM
       (SELECT o_orderpriority, gold / NULLIF(lag(gold) OVER (PARTITION BY o_orderpriority ORDER BY date), 0) - 1 AS pc
        FROM t WHERE rn <= 7) GROUP BY 1)
SELECT o_orderpriority, latest_date, {R('cur')} AS current_price, {R('cur - first')} AS change_30d,
  {R('(cur - first) / NULLIF(first, 0) * 100', 6)} AS change_30d_pct, {R('volatility', 6)} AS volatility,
  {R('avg_change_7d_pct', 6)} AS avg_change_7d_pct,
  CASE WHEN avg_change_7d_pct IS NULL THEN NULL WHEN abs(avg_change_7d_pct) < 0.1 THEN 'flat'
       WHEN avg_change_7d_pct > 0 THEN 'up' ELSE 'down' END AS trend_7d,
  CASE WHEN volatility > 1.5 THEN 'high' WHEN volatility < 0.5 THEN 'low' ELSE 'medium' END AS volatility_class,
  CASE WHEN avg_change_7d_pct > 0.5 THEN 'up' WHEN avg_change_7d_pct < -0.5 THEN 'down' ELSE 'flat' END AS outlook
FROM t30 JOIN t7 USING (o_orderpriority)""")
def f23_f25_dashboard_classes(spark, sf_dir):
    from ..plans.dashboard import dashboard_summary
    return dashboard_summary(gold_series(spark, sf_dir), "gold", ("o_orderpriority",))


@register("f30_tradeoff", ("F30", "A13", "A15"), f"""
WITH {PRED},
acc AS (SELECT 100 - avg(abs((actual - predicted) / NULLIF(actual, 0))) * 100 AS accuracy_pct FROM p),
lat AS (SELECT event_type, avg(value) AS mean_ms FROM events GROUP BY 1)
SELECT event_type, {R('accuracy_pct / mean_ms', 6)} AS tradeoff_score,
  CASE WHEN accuracy_pct / mean_ms > 300 THEN 'excellent' WHEN accuracy_pct / mean_ms > 100 THEN 'good'
       ELSE 'poor' END AS tradeoff_class FROM lat, acc""")
def f30_tradeoff(spark, sf_dir):
    """Accuracy of the naive baseline per millisecond of mean latency
    (events.value per event type as the latency measurement)."""
    from ..operators.stats import attach_stats, regression_metrics
    from .q_stats import predictions
    acc = regression_metrics(predictions(spark, sf_dir)).select("accuracy")
    lat = read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg("value").alias("mean_ms"))
    j = attach_stats(lat, acc)
    score = L.tradeoff_score("accuracy", "mean_ms")
    return j.select("event_type", F.round(score * F.lit(1.000000000001), 6).alias("tradeoff_score"),
                    L.tradeoff_class(score).alias("tradeoff_class"))

