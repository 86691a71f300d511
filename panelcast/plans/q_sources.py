"""Registered queries: sources and sinks (S1-S22), projections (P1-P18),
joins J3/J6 and the repair pipelines (Q8-Q10).

Fixture files (CSV, snapshots) are derived from the given tables by Spark
and written under the session's shared checkpoint folder, never a
machine-local path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import project as P
from ..operators.dedupe import drop_last_row
from ..session import scratch_path
from ..sources import files as FI
from ..sources import json as J
from ..sources import upsert as U
from .feature_store import round_doubles, stable_round
from .registry import register
from .repair import clean_gold_light, repair_fx, repair_gold
from .series import gold_series, read_table
from .sqlgen import R


def _scratch(spark, tag: str) -> str:
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


@register("s1_s5_csv_roundtrip", ("S1", "S2", "S3", "S4", "S5", "P1"), f"""
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1)
SELECT date, {R('gold', 2)} AS gold, printf('%.2f', {R('gold', 2)}) AS gold_text FROM g""")
def s1_s5_csv_roundtrip(spark, sf_dir):
    """Daily price written as a 2-decimal header CSV, read back typed
    (schema with DATE) and as all-string text."""
    g = gold_series(spark, sf_dir, by_priority=False)
    path = _scratch(spark, "csv")
    FI.write_csv(g.select("date", stable_round("gold", 2).alias("gold")), path, decimals=2)
    typed = FI.read_csv(spark, path, schema="date DATE, gold DOUBLE", date_format="yyyy-MM-dd")
    text = FI.read_csv(spark, path, all_string=True).select("date", F.col("gold").alias("gold_text"))
    return P.to_series(typed, "date", "gold", "gold").join(
        text.select(F.to_date("date").alias("date"), "gold_text"), "date")


@register("s6_json_document", ("S6",), f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, {R('o_totalprice / 5', 2)} AS gold_buy,
  {R('o_totalprice / 5 + 100', 2)} AS gold_sell,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {R('o_totalprice / 4', 2)} END AS gold_bar_buy FROM orders""")
def s6_json_document(spark, sf_dir):
    """Nested price documents built from orders (pending orders lack the
    ``gold_bar`` object) flattened back to one row each."""
    o = read_table(spark, sf_dir, "orders")
    bar = F.when(F.col("o_orderstatus") != "P", F.struct(stable_round(F.col("o_totalprice") / 4, 2).alias("buy")))
    doc = F.to_json(F.struct(F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.struct(F.struct(stable_round(F.col("o_totalprice") / 5, 2).alias("buy"),
                          stable_round(F.col("o_totalprice") / 5 + 100, 2).alias("sell")).alias("gold"),
                 bar.alias("gold_bar")).alias("price")).alias("response")))
    docs = o.select("o_orderkey", doc.alias("doc"))
    schema = ("struct<response: struct<date: string, price: struct<gold: struct<buy: double, sell: double>, "
              "gold_bar: struct<buy: double, sell: double>>>>")
    flat = J.flatten_document(docs, "doc", schema, {"date": "response.date", "gold_buy": "response.price.gold.buy",
                                                    "gold_sell": "response.price.gold.sell",
                                                    "gold_bar_buy": "response.price.gold_bar.buy"}, keep=["o_orderkey"])
    return flat.withColumn("date", F.to_date("date"))


@register("s7_json_records", ("S7",), f"""
SELECT l_orderkey, l_linenumber AS line, {R('l_quantity', 2)} AS qty, l_returnflag AS flag FROM lineitem""")
def s7_json_records(spark, sf_dir):
    """One document per order holding the array of its lines (an order has
    at most seven lines), exploded back into rows."""
    li = read_table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"),
        F.col("l_returnflag").alias("flag"))).alias("data"))
    docs = per_order.select("l_orderkey", F.to_json(F.struct(F.struct("data").alias("response"))).alias("doc"))
    schema = "struct<response: struct<data: array<struct<line: int, qty: double, flag: string>>>>"
    out = J.explode_records(docs, "doc", schema, "response.data", keep=["l_orderkey"])
    return out.withColumn("qty", stable_round("qty", 2))


@register("s8_price_pairs", ("S8", "F12"), f"""
SELECT event_id, CAST(ts AS DATE) AS date, {R('value')} AS price FROM events
UNION ALL SELECT event_id, CAST(ts + INTERVAL 1 DAY AS DATE), {R('value * 2')} FROM events""")
def s8_price_pairs(spark, sf_dir):
    """``{prices: [[epoch_ms, price], [epoch_ms + 1 day, 2 * price]]}`` per event."""
    ev = read_table(spark, sf_dir, "events")
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("double")
    doc = F.to_json(F.struct(F.array(F.array(ms, F.col("value")),
                                     F.array(ms + 86400000.0, F.col("value") * 2)).alias("prices")))
    out = J.price_pairs(ev.select("event_id", doc.alias("doc")), "doc", keep=["event_id"])
    return round_doubles(out)


@register("s9_html_tables", ("S9",), f"""
SELECT o_orderkey, 0 AS row_idx, CAST(o_orderkey AS VARCHAR) AS c1, CAST(o_custkey AS VARCHAR) AS c2,
  o_orderstatus AS c3, printf('%.2f', o_totalprice) AS c4, strftime(o_orderdate, '%Y-%m-%d') AS c5,
  o_orderpriority AS c6, 'x' AS c7, 'y' AS c8, 'z' AS c9 FROM orders""")
def s9_html_tables(spark, sf_dir):
    """One HTML table per order - a 9-cell data row plus a 2-cell footer -
    parsed back; only the 9-cell rows survive."""
    o = read_table(spark, sf_dir, "orders")
    cells = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
             F.format_string("%.2f", F.col("o_totalprice")), F.date_format("o_orderdate", "yyyy-MM-dd"),
             F.col("o_orderpriority"), F.lit("<b>x</b>"), F.lit(" y "), F.lit("z")]
    row = J.html_rows_from(o, cells, key="o_orderkey")
    page = row.select("o_orderkey", F.concat(F.lit("<table class='t'>"), F.col("html_row"),
                                             F.lit("<tr><td>total</td><td>1</td></tr></table>")).alias("html"))
    t = J.html_table_rows(page, "html", n_cells=9, keep=["o_orderkey"])
    return t.select("o_orderkey", "row_idx", *[F.col("cells")[i].alias(f"c{i + 1}") for i in range(9)])


@register("s9_html_list_items", ("S9",), r"""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1)) AS item FROM pages)
SELECT page_id, count(*) AS items,
  count(*) FILTER (WHERE len(regexp_extract_all(item, '(?s)<a\b[^>]*>(.*?)</a>', 1)) = 1) AS linked
FROM r GROUP BY 1""")
def s9_html_list_items(spark, sf_dir):
    """``<li>`` rows with ``<a>`` cells on the raw web pages."""
    pages = read_table(spark, sf_dir, "pages")
    rows = J.html_table_rows(pages, "html", row_tag="li", cell_tag="a", n_cells=None, keep=["page_id"])
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("items"),
                                      F.count_if(F.size("cells") == 1).alias("linked"))


@register("s10_upsert_keep_last", ("S10", "T4", "U1"), f"""
SELECT event_id, ts, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN {R('value * 2')} ELSE {R('value')} END
  AS value FROM events""")
def s10_upsert_keep_last(spark, sf_dir):
    """Existing rows (before Jan 20) upserted with a re-delivery of
    everything from Jan 15 carrying corrected values: the new rows win."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    old = ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    new = ev.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).withColumn("value", F.col("value") * 2)
    return round_doubles(U.upsert_tagged(old, new, "event_id"))


@register("s11_append", ("S11", "U1"), f"""
SELECT event_type, count(*) AS n, {R('sum(value)', 2)} AS total FROM events GROUP BY 1""")
def s11_append(spark, sf_dir):
    """Two appends to one table (no dedupe) read back whole."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    path = _scratch(spark, "append")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    U.append(ev.filter(F.col("ts") < cut), path)
    U.append(ev.filter(F.col("ts") >= cut), path)
    back = spark.read.parquet(path)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                          stable_round(F.sum("value"), 2).alias("total"))


@register("s12_row_payload", ("S12",), """
SELECT o_orderkey, json_object('o_custkey', o_custkey, 'o_orderstatus', o_orderstatus,
  'o_orderpriority', CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END) AS payload FROM orders""")
def s12_row_payload(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"))
    return J.row_payload(o, "o_orderkey")


@register("s13_chunks", ("S13",), """
WITH r AS (SELECT l_orderkey, l_linenumber,
  (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 500 AS chunk_id FROM lineitem)
SELECT chunk_id, count(*) AS rows, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order
FROM r GROUP BY 1""")
def s13_chunks(spark, sf_dir):
    """Upsert batches of 500 rows in key order."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    c = U.assign_chunks(li, ["l_orderkey", "l_linenumber"], 500)
    return c.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("first_order"),
                                     F.max("l_orderkey").alias("last_order"))


def _latest(spark, sf_dir, days, by):
    """CSV snapshots of events, one folder with many part files for each day,
    written in the order of ``days``; the newest is read back."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "value", "ts")
    base = _scratch(spark, "snap")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for day in days:
        part = ev.filter(F.col("ts") >= F.lit(day).cast("timestamp_ntz")).select("event_id", "value")
        FI.write_csv(part.repartition(parts, "event_id"), f"{base}/prices_{day.replace('-', '')}", decimals=None)
    scan = FI.read_csv(spark, f"{base}/prices_*", schema="event_id BIGINT, value DOUBLE", with_file=True)
    return round_doubles(FI.latest_snapshot_rows(scan, by=by).select("event_id", "value"))


@register("s14_latest_snapshot_by_mtime", ("S14", "S2"), f"""
SELECT event_id, {R('value')} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-10'""")
def s14_latest_snapshot_by_mtime(spark, sf_dir):
    """The snapshot written last wins, whatever its name."""
    return _latest(spark, sf_dir, ("2024-01-15", "2024-01-20", "2024-01-10"), "mtime")


@register("s14_s15_latest_snapshot", ("S15", "S2"), f"""
SELECT event_id, {R('value')} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-20'""")
def s14_s15_latest_snapshot(spark, sf_dir):
    """The newest by name wins (names sort by date), whenever it was written."""
    return _latest(spark, sf_dir, ("2024-01-10", "2024-01-20", "2024-01-15"), "name")


@register("s16_history_keep", ("S16", "T5", "K3"), f"""
SELECT event_id, ts, {R('value')} AS value FROM events ORDER BY ts DESC LIMIT 100""")
def s16_history_keep(spark, sf_dir):
    """A report history bounded to its newest 100 entries."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return round_doubles(U.keep_newest(ev, "ts", 100))


@register("s17_read_back", ("S17",), f"""
SELECT CAST(o_orderdate AS DATE) AS date, {R('avg(o_totalprice)')} AS gold FROM orders GROUP BY 1
ORDER BY date DESC LIMIT 3""")
def s17_read_back(spark, sf_dir):
    return round_doubles(U.read_back(gold_series(spark, sf_dir, by_priority=False), "date", 3))


_MONTHS = ("m01", "m02", "m03", "m04", "m05", "m06", "m07", "m08", "m09", "m10", "m11", "m12")


@register("s18_wide_report", ("S18", "F1"), f"""
WITH m AS (SELECT l_returnflag AS code, year(l_shipdate) AS y, month(l_shipdate) AS mo, avg(l_tax) AS v
           FROM lineitem GROUP BY 1, 2, 3),
k AS (SELECT DISTINCT code, y FROM m),
g AS (SELECT code, y, mo FROM k, range(1, 13) t(mo))
SELECT g.code, make_date(g.y, g.mo, 1) AS date, {R('m.v', 6)} AS value
FROM g LEFT JOIN m USING (code, y, mo) WHERE g.code = 'N'""")
def s18_wide_report(spark, sf_dir):
    """Monthly average tax per return flag laid out as a Thai-style wide
    report (preamble rows, BE years, '-' for empty months), turned back into
    (code, date, value) for code N."""
    li = read_table(spark, sf_dir, "lineitem")
    m = li.groupBy(F.col("l_returnflag").alias("code"), F.year("l_shipdate").alias("y"),
                   F.month("l_shipdate").alias("mo")).agg(F.avg("l_tax").alias("v"))
    wide = (m.withColumn("mname", F.format_string("m%02d", "mo"))
            .groupBy("code", (F.col("y") + 543).cast("string").alias("year"))
            .pivot("mname", list(_MONTHS)).agg(F.first(F.format_string("%.17g", "v"))))
    wide = wide.na.fill("-", subset=list(_MONTHS))
    preamble = spark.createDataFrame([("report", "consumer price index", *[""] * 12),
                                      ("code", "year", *_MONTHS)], ["code", "year", *_MONTHS])
    report = preamble.unionByName(wide)
    long = FI.wide_report_to_long(report, ["code"], _MONTHS, "year", "code", "N", "value")
    return long.withColumn("value", stable_round("value", 6))


@register("s19_s20_shape", ("S19", "S20", "P2", "P3", "P4", "P5", "P6", "P7", "P8", "P17", "J3"), f"""
SELECT CAST(strftime(l_shipdate, '%Y-%m') || '-01' AS DATE) AS Date, {R('avg(l_discount) * 500', 6)} AS Price,
  CAST(NULL AS DOUBLE) AS btc FROM lineitem GROUP BY 1""")
def s19_s20_shape(spark, sf_dir):
    """An FX-like table with legacy and junk columns normalised: resolve the
    rate column by priority, flatten a struct, drop ``Unnamed:`` columns,
    rename legacy suffixes, add the missing optional series as NULL."""
    li = read_table(spark, sf_dir, "lineitem")
    fx = li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("period")).agg(
        (F.avg("l_discount") * 500).alias("selling"), (F.avg("l_discount") * 490).alias("buying_transfer"),
        F.count(F.lit(1)).alias("Unnamed: 0"), F.avg("l_tax").alias("cpi_roll7"))
    fx = fx.withColumn("meta", F.struct(F.lit("THB").alias("ccy"), F.lit("bot").alias("src")))
    fx = P.add_ingest_columns(P.flatten(P.rename_legacy(P.drop_prefixed(fx))), source="fixture", now=F.lit(None))
    rate = P.resolve_column(fx.schema, ["mid_rate", "selling", "buying_transfer", "Price"])
    shaped = fx.select(D.month_start("period").alias("Date"), F.col(rate).alias("Price"))
    shaped = P.conform(shaped, ["Date", "Price", "btc"], {"btc": "double"})
    return shaped.withColumn("Price", stable_round("Price", 6))


@register("p18_drop_last_row", ("P18",), f"""
WITH g AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, date, {R('gold')} AS gold FROM g
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY date DESC) > 1""")
def p18_drop_last_row(spark, sf_dir):
    return round_doubles(drop_last_row(gold_series(spark, sf_dir), "date", ["o_orderpriority"]))


_GOLD_RAW_SQL = """raw AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
  CASE WHEN round(o_totalprice / 5, 2) BETWEEN 10000 AND 100000 THEN round(o_totalprice / 5, 2) END AS gold_buy,
  CASE WHEN round(o_totalprice / 5 + 100, 2) BETWEEN 10000 AND 100000 THEN round(o_totalprice / 5 + 100, 2) END AS gold_sell
  FROM orders)"""


def _gold_raw(spark, sf_dir):
    """Raw gold ticks from orders: mixed date texts (BE slash, Thai long,
    ISO), comma/currency-formatted prices."""
    o = read_table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    date_text = (F.when(F.col("o_orderstatus") == "F", D.to_be_slash(d))
                 .when(F.col("o_orderstatus") == "O", D.to_thai_long(d))
                 .otherwise(F.date_format(d, "yyyy-MM-dd")))
    buy = F.concat(F.lit("฿"), F.format_number(F.col("o_totalprice") / 5, 2))
    sell = F.concat(F.format_number(F.col("o_totalprice") / 5 + 100, 2), F.lit(" บาท"))
    return o.select("o_orderkey", date_text.alias("date_text"), buy.alias("gold_buy"), sell.alias("gold_sell"))


@register("q8_gold_repair", ("Q8", "F1", "F2", "F3", "F8", "P12", "P9", "P13", "W9", "A16", "A18"), f"""
WITH {_GOLD_RAW_SQL},
k AS (SELECT * FROM raw WHERE coalesce(gold_buy, gold_sell) IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY date ORDER BY o_orderkey DESC) = 1),
q AS (SELECT quantile_cont(gold_buy, 0.25) AS q1, quantile_cont(gold_buy, 0.75) AS q3, count(gold_buy) AS cnt FROM k)
SELECT date, o_orderkey, gold_buy, gold_sell,
  coalesce(cnt > 10 AND gold_buy IS NOT NULL AND (gold_buy < q1 - 3 * (q3 - q1) OR gold_buy > q3 + 3 * (q3 - q1)), false)
  AS is_outlier FROM k, q""")
def q8_gold_repair(spark, sf_dir):
    clean, _rejected, _viol = repair_gold(_gold_raw(spark, sf_dir), "date_text", ["gold_buy", "gold_sell"],
                                          "o_orderkey", outlier_col="gold_buy")
    return clean.select("date", "o_orderkey", "gold_buy", "gold_sell", "is_outlier")


@register("q8_rejected_and_violations", ("Q8", "P12"), f"""
WITH r0 AS (SELECT o_orderkey, round(o_totalprice / 5, 2) AS b, round(o_totalprice / 5 + 100, 2) AS s FROM orders)
SELECT count(*) FILTER (WHERE NOT (b BETWEEN 10000 AND 100000)) AS buy_violations,
  count(*) FILTER (WHERE NOT (s BETWEEN 10000 AND 100000)) AS sell_violations,
  count(*) FILTER (WHERE NOT (b BETWEEN 10000 AND 100000) AND NOT (s BETWEEN 10000 AND 100000)) AS rejected FROM r0""")
def q8_rejected_and_violations(spark, sf_dir):
    _clean, _rejected, viol = repair_gold(_gold_raw(spark, sf_dir), "date_text", ["gold_buy", "gold_sell"],
                                          "o_orderkey")
    return viol.select(F.col("gold_buy").alias("buy_violations"), F.col("gold_sell").alias("sell_violations"),
                       "rejected")


@register("q9_fx_repair", ("Q9", "F8", "P12", "W9"), f"""
WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS period, l_returnflag AS currency_id, l_orderkey, l_linenumber,
  round(l_discount * 500, 2) AS rate FROM lineitem),
k AS (SELECT * FROM m WHERE rate BETWEEN 20 AND 50
      QUALIFY row_number() OVER (PARTITION BY period, currency_id ORDER BY l_orderkey DESC, l_linenumber DESC) = 1)
SELECT period, currency_id, l_orderkey, l_linenumber, rate FROM k""")
def q9_fx_repair(spark, sf_dir):
    """Rates (discount x 500, as text with a currency suffix) per month and
    return flag: out-of-range rates dropped, last delivery per key kept."""
    li = read_table(spark, sf_dir, "lineitem")
    raw = li.select(F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.col("l_returnflag").alias("currency_id"),
                    "l_orderkey", "l_linenumber",
                    F.concat(F.format_number(F.col("l_discount") * 500, 2), F.lit(" THB")).alias("rate"))
    clean, _ = repair_fx(raw, ["period", "currency_id"], "rate", ["l_orderkey", "l_linenumber"])
    return clean


@register("q10_light_clean", ("Q10", "F7", "P9", "P11", "W9"), f"""
SELECT CAST(o_orderdate AS DATE) AS date, arg_max(o_orderkey, o_orderkey) AS o_orderkey,
  {R('arg_max(o_totalprice - 1000, o_orderkey)', 2)} AS price
FROM orders WHERE o_totalprice - 1000 > 0 GROUP BY 1""")
def q10_light_clean(spark, sf_dir):
    """Comma-formatted prices minus a fee; non-positive rows dropped, the
    last order per day kept."""
    o = read_table(spark, sf_dir, "orders")
    raw = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
                   F.format_number(F.col("o_totalprice") - 1000, 2).alias("price"))
    clean, _ = clean_gold_light(raw, "date_text", "price", "o_orderkey")
    return clean.select("date", "o_orderkey", stable_round("price", 2).alias("price"))
