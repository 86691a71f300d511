"""Registered queries: saved models, sinks, bounded histories and keyed tables
(M8, M19, C5-C8, S10, S13, S16, S21, S22, T4), and whole-table null reports.

Every store is written under the session's shared checkpoint folder, twice or
in several runs, and read back in a new plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import ForecastConfig, ModelConfig
from ..models import saved as SV
from ..operators import quality as QL
from ..operators import stats as S
from ..operators.align import series_window
from ..operators.monitor import moving_average_accuracy
from ..operators.project import rename_legacy
from ..session import scratch_path
from ..sources import files as FI
from ..sources.merge import BatchedUpsert, MergedTable
from ..sources.versions import VersionedStore, append_epochs
from ..streaming.ingest import merged_sink, run_available
from .dashboard import dashboard, export_dashboard
from .feature_store import round_doubles
from .q_stats import GOLD, E, W, predictions
from .q_streaming import _deliver, _source
from .registry import REGISTRY, register
from .series import gold_series, lineitem_daily, read_table
from .sqlgen import R

LABEL = "gold_next"


def _scratch(spark, tag: str) -> str:
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


def _rows(spark, sf_dir):
    """Today's price (x: in ten thousands) and the next day's, per priority."""
    g = gold_series(spark, sf_dir)
    return g.withColumn(LABEL, F.lead("gold").over(series_window(E))).withColumn("x", F.col("gold") / 10000.0)


_SPLIT = f"""{GOLD},
n AS (SELECT *, lead(gold) {W}) AS gold_next, gold / 10000.0 AS x FROM gold),
s AS (SELECT *, row_number() {W}) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS cnt FROM n WHERE gold_next IS NOT NULL),
tr AS (SELECT * FROM s WHERE rn <= cnt - ceil(0.2 * cnt)),
te AS (SELECT * FROM s WHERE rn > cnt - ceil(0.2 * cnt))"""
_FITS = f"""{_SPLIT},
st AS (SELECT o_orderpriority, covar_pop(x, gold_next) * count(*) AS sxy, covar_pop(x, x) * count(*) AS sxx,
              avg(x) AS mx, avg(gold_next) AS my FROM tr GROUP BY 1),
c AS (SELECT o_orderpriority, model, sxy / (sxx + alpha) AS b, my - sxy / (sxx + alpha) * mx AS a
      FROM st, (VALUES ('linear', 0.0), ('ridge', 1.0)) m(model, alpha)),
e AS (SELECT o_orderpriority, model, avg(abs(gold_next - (a + b * x))) AS mae
      FROM te JOIN c USING (o_orderpriority) GROUP BY 1, 2),
best AS (SELECT o_orderpriority, arg_min(model, mae) AS best_model, min(mae) AS best_mae FROM e GROUP BY 1)"""


def _trained(spark, sf_dir) -> VersionedStore:
    """Linear and ridge trained, compared and saved; then a rerun."""
    store = VersionedStore(spark, _scratch(spark, "models"))
    for _ in range(2):
        SV.train_and_save(store, _rows(spark, sf_dir), ["x"], LABEL, ("linear", "ridge"), ModelConfig(), E, run="nightly")
    return store


@register("m8_saved_models", ("M8", "C5"), f"""
WITH {_FITS}
SELECT o_orderpriority, best_model, {R('best_mae')} AS best_mae, {R('a', 2)} AS intercept, {R('b')} AS slope,
  (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM te) AS n_test,
  (SELECT CAST(max(date) AS VARCHAR) FROM tr) AS train_end, 'x' AS features, 1 AS version
FROM best JOIN c ON c.o_orderpriority = best.o_orderpriority AND model = best_model""".replace(
    "SELECT o_orderpriority, best_model", "SELECT best.o_orderpriority, best_model"))
def m8_saved_models(spark, sf_dir):
    """Models trained, compared and saved twice under one run name; a reader
    opens the folder anew and takes best models, coefficients and metadata."""
    store = VersionedStore(spark, _trained(spark, sf_dir).root)
    info = store.info("best")
    best = store.read("best").drop("best_mae").withColumnRenamed("best_model", "model")
    mae = store.read("comparison").select(*E, "model", "mae")
    out = SV.best_coefficients(store).join(mae, [*E, "model"]).join(best, [*E, "model"])
    out = out.select(*E, F.col("model").alias("best_model"), F.col("mae").alias("best_mae"),
                     F.round(F.col("intercept") * 1.000000000001, 2).alias("intercept"), F.col("coef")[0].alias("slope"),
                     F.lit(info["n_train"]).cast("long").alias("n_train"), F.lit(info["n_test"]).cast("long").alias("n_test"),
                     F.lit(info["train_end"]).alias("train_end"), F.lit(",".join(info["features"])).alias("features"),
                     F.lit(store.versions()[-1]).alias("version"))
    return round_doubles(out, 4, skip=("intercept",))


@register("m18_score_saved", ("M8", "M12", "M18"), f"""
WITH {_FITS}
SELECT n.o_orderpriority, n.date, {R('a + b * n.x', 2)} AS prediction
FROM n JOIN best ON n.o_orderpriority = best.o_orderpriority JOIN c ON c.o_orderpriority = n.o_orderpriority AND model = best_model""")
def m18_score_saved(spark, sf_dir):
    """All rows scored by the saved best model of their priority."""
    store = VersionedStore(spark, _trained(spark, sf_dir).root)
    return round_doubles(SV.score_saved(store, _rows(spark, sf_dir).select(*E, "date", "x")).drop("x"), 2)


@register("m19_all_models", ("M19", "J5"), f"""
WITH {_FITS}
SELECT te.o_orderpriority, date, {R('gold_next')} AS actual, {R('l.a + l.b * x', 2)} AS linear, {R('r.a + r.b * x', 2)} AS ridge
FROM te JOIN c l ON l.o_orderpriority = te.o_orderpriority AND l.model = 'linear'
JOIN c r ON r.o_orderpriority = te.o_orderpriority AND r.model = 'ridge'""")
def m19_all_models(spark, sf_dir):
    """Actual beside every model's prediction on the test part, as saved."""
    d = VersionedStore(spark, _trained(spark, sf_dir).root).read("predictions")
    return d.select(*E, "date", F.round(F.col("actual") * 1.000000000001, 4).alias("actual"),
                    *[F.round(F.col(m) * 1.000000000001, 2).alias(m) for m in ("linear", "ridge")])


_FORECAST = f"""{_SPLIT},
c AS (SELECT o_orderpriority, regr_intercept(gold_next, gold) AS a, regr_slope(gold_next, gold) AS b FROM tr GROUP BY 1),
last AS (SELECT o_orderpriority, max(date) AS date, arg_max(gold, date) AS gold FROM gold GROUP BY 1),
f(o_orderpriority, step, date, prev, pred) AS (
  SELECT l.o_orderpriority, 1, CASE WHEN isodow(l.date) = 6 THEN l.date + 2 ELSE l.date + 1 END, l.gold, c.a + c.b * l.gold
  FROM last l JOIN c USING (o_orderpriority)
  UNION ALL
  SELECT f.o_orderpriority, f.step + 1, CASE WHEN isodow(f.date) = 6 THEN f.date + 2 ELSE f.date + 1 END, f.pred,
         c.a + c.b * f.pred FROM f JOIN c USING (o_orderpriority) WHERE f.step < 7)"""


def _forecast(spark, sf_dir):
    """(n-row forecast, one-row forecast) of the saved one-feature model."""
    store = VersionedStore(spark, _scratch(spark, "models"))
    d = _rows(spark, sf_dir)
    SV.train_and_save(store, d, ["gold"], LABEL, ("linear",), ModelConfig(), E, run="nightly")
    return SV.forecast_saved(VersionedStore(spark, store.root), d, "gold", ForecastConfig(entity=E, horizon=7))


@register("s21_forecast_sink", ("S21", "C6", "M12", "M13", "M14"), f"""
WITH RECURSIVE {_FORECAST}
SELECT 'forecast' AS shape, o_orderpriority, date, {R('pred', 2)} AS predicted_price, {R('pred - prev', 2)} AS change,
  isodow(date) <> 7 AS is_business_day FROM f
UNION ALL SELECT 'next', o_orderpriority, date, {R('pred', 2)}, {R('pred - prev', 2)}, isodow(date) <> 7 FROM f WHERE step = 1""")
def s21_forecast_sink(spark, sf_dir):
    """Both shapes of the forecast written by a run, by another run and by the
    first run again; the first run's part is read once."""
    many, one = _forecast(spark, sf_dir)
    sink = VersionedStore(spark, _scratch(spark, "forecasts"))
    many, one = many.checkpoint(), one.checkpoint()
    for run, rows in (("monday", many), ("tuesday", many.where("step <= 3")), ("monday", many)):
        SV.save_forecast(sink, rows, one, run)
    back = VersionedStore(spark, sink.root)
    keep = [*E, "date", "predicted_price", "change", "is_business_day"]
    f = back.read("forecast", parts=["monday"]).select(F.lit("forecast").alias("shape"), *keep)
    n = back.read("next", parts=["monday"]).withColumnRenamed("next_date", "date").select(F.lit("next").alias("shape"), *keep)
    return round_doubles(f.unionByName(n), 2)


@register("c8_dashboard", ("C8", "S22", "A6", "S14", "Q13", "F23", "F25"), f"""
WITH s AS ({REGISTRY['f23_f25_dashboard_classes'].sql if 'f23_f25_dashboard_classes' in REGISTRY else ''}),
r AS ({REGISTRY['a6_tail_correlations'].sql if 'a6_tail_correlations' in REGISTRY else ''}),
p AS (WITH RECURSIVE {_FORECAST} SELECT * FROM f)
SELECT 'summary' AS section, o_orderpriority || ' ' || CAST(latest_date AS VARCHAR) AS name, trend_7d || ' ' || volatility_class AS label,
  round(current_price, 2) + 0.0 AS value FROM s
UNION ALL SELECT 'correlations', variable, CAST(rank AS VARCHAR), corr FROM r
UNION ALL SELECT 'forecast', o_orderpriority || ' ' || CAST(date AS VARCHAR), CAST(step AS VARCHAR), {R('pred', 2)} FROM p""")
def c8_dashboard(spark, sf_dir):
    """Summary, correlations and the newest of two forecast snapshots, exported
    twice under one run and read back."""
    many, _one = _forecast(spark, sf_dir)
    many = many.select(*E, "step", "date", F.round(F.col("predicted_price") * 1.000000000001, 2).alias("predicted_price")).checkpoint()
    base = _scratch(spark, "forecast-snapshots")
    for name, rows in (("forecast_b", many.where("step <= 2")), ("forecast_a", many)):      # the later one counts
        FI.write_csv(rows, f"{base}/{name}", decimals=2)
    scan = FI.read_csv(spark, f"{base}/forecast_*", schema="o_orderpriority STRING, step INT, date DATE, predicted_price DOUBLE",
                       date_format="yyyy-MM-dd", with_file=True)
    d = lineitem_daily(spark, sf_dir).select(
        "date", (F.col("s_ext") / F.col("n_ext")).alias("set"), F.col("btc").alias("qty"),
        (F.col("s_disc") / F.col("n_disc")).alias("disc"), (F.col("s_tax") / F.col("n_tax")).alias("tax"))
    joined = gold_series(spark, sf_dir, by_priority=False).join(d, "date")
    tables = dashboard(gold_series(spark, sf_dir), "gold", joined, ["set", "qty", "disc", "tax"], scan, E)
    sink = VersionedStore(spark, _scratch(spark, "dashboard"))
    for _ in range(2):
        export_dashboard(sink, tables, "today")
    back = VersionedStore(spark, sink.root)
    text = lambda c: F.col(c).cast("string")
    s = back.read("summary").select(F.lit("summary").alias("section"), F.concat_ws(" ", *E, text("latest_date")).alias("name"),
                                    F.concat_ws(" ", "trend_7d", "volatility_class").alias("label"),
                                    F.round("current_price", 2).alias("value"))
    r = back.read("correlations").select(F.lit("correlations"), "variable", text("rank"), F.round(F.col("corr") * 1.000000000001, 6))
    f = back.read("forecast").select(F.lit("forecast"), F.concat_ws(" ", *E, text("date")), text("step"), "predicted_price")
    return s.union(r).union(f)


@register("c7_monitoring_history", ("C7", "S16", "T5"), f"""
WITH m AS ({REGISTRY['w12_moving_accuracy'].sql if 'w12_moving_accuracy' in REGISTRY else ''}),
d AS (SELECT date FROM m GROUP BY date ORDER BY date DESC LIMIT 100)
SELECT m.* FROM m JOIN d USING (date)""")
def c7_monitoring_history(spark, sf_dir):
    """The accuracy reports of the newest 150 days appended in three
    deliveries, the second one sent again at the end: the newest 100 days stay
    stored, and the whole store is read."""
    rep = round_doubles(moving_average_accuracy(predictions(spark, sf_dir), (7, 30), E), 6)
    rep = rep.withColumn("epoch", F.unix_date("date"))
    last = rep.select("epoch").distinct().orderBy(F.col("epoch").desc()).limit(150)
    days = sorted(r["epoch"] for r in last.collect())
    rep = rep.join(F.broadcast(last), "epoch").checkpoint()
    path = _scratch(spark, "history")
    deliveries = [days[:50], days[50:100], days[100:], days[50:100]]
    for part in deliveries:
        if part:
            append_epochs(rep.where(F.col("epoch").between(part[0], part[-1])), path, keep=100)
    return spark.read.schema(rep.schema).parquet(path).drop("epoch")


@register("t4_compacted_upsert", ("T4", "S10", "W9"), f"""
SELECT event_id, user_id, CASE WHEN day(ts) IN (5, 6) THEN {R('value * 2')} ELSE {R('value')} END AS value FROM events""")
def t4_compacted_upsert(spark, sf_dir):
    """Weekly deliveries and late corrections merged into hash buckets: deltas
    are compacted every second epoch, and the first epoch, long compacted,
    comes again at the end."""
    src = _deliver(spark, sf_dir, corrections=True)
    out = _scratch(spark, "stream-t4c")
    s = _source(spark, src).select("event_id", "user_id", "value", "ts")
    table = MergedTable(spark, f"{out}/table", s.schema, ["event_id"], ["ts"], buckets=8)
    kept = []

    def write(batch, epoch):
        if epoch == 0:
            kept.append(batch.checkpoint())
        merged_sink(table, compact_every=2)(batch, epoch)

    run_available(s, checkpoint=f"{out}/_checkpoint", foreach_batch=write)
    table.write(kept[0], 0)
    merged = MergedTable(spark, table.path, s.schema, ["event_id"], ["ts"], buckets=8).read()
    return round_doubles(merged.drop("ts"))


def _batched(spark, sf_dir) -> tuple[MergedTable, BatchedUpsert, dict]:
    """Events before Jan 20 in a table; all from Jan 15 on, corrected, sent in
    batches of 500, broken off after a part and resumed by a new sender."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    old = ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    new = ev.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).withColumn("value", F.col("value") * 2)
    path = _scratch(spark, "batched")
    def target():
        return MergedTable(spark, f"{path}/table", ev.schema, ["event_id"], ["ts"], buckets=8)
    t = target()
    t.write(old, 0)
    t.compact()
    first = BatchedUpsert(t, path, 500, group=4)
    first.plan(new, ["ts", "event_id"])
    first.send(groups=max(1, len(first.groups()) // 2))
    # The next group reaches the table, but the sender ends before the ledger.
    todo = [g for g in first.groups() if g not in first.done()]
    if todo:
        first.target.write(spark.read.parquet(f"{path}/queue/epoch={todo[0]}").drop("batch_id"), todo[0])
    again = BatchedUpsert(target(), path, 500, group=4)
    again.plan(new, ["ts", "event_id"])
    again.send()
    return again.target, again, {"unfinished": len(todo)}


@register("s13_batched_upsert", ("S13", "S10"), f"""
SELECT event_id, ts, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN {R('value * 2')} ELSE {R('value')} END AS value
FROM events""")
def s13_batched_upsert(spark, sf_dir):
    """The table after a keyed upsert in batches that was broken off and resumed."""
    target, _sender, _state = _batched(spark, sf_dir)
    return round_doubles(target.read())


@register("s13_batch_ledger", ("S13",), """
WITH r AS (SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS batch_id FROM events WHERE ts >= TIMESTAMP '2024-01-15')
SELECT batch_id, count(*) AS rows, 'done' AS state FROM r GROUP BY 1""")
def s13_batch_ledger(spark, sf_dir):
    """The ledger of the same upsert: every batch once, all done."""
    return _batched(spark, sf_dir)[1].ledger()


@register("a10_null_report_whole", ("A10", "J2"), """
WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS gold,
                  avg(o_totalprice) AS every FROM orders GROUP BY 1),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS "set",
             sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS qty FROM lineitem GROUP BY 1),
j AS (SELECT * FROM g FULL JOIN s USING (date)),
n AS (SELECT count(*) AS n, count(*) - count(date) AS date, count(*) - count(gold) AS gold, count(*) - count(every) AS every,
             count(*) - count("set") AS "set", count(*) - count(qty) AS qty FROM j),
l AS (UNPIVOT n ON date, gold, every, "set", qty INTO NAME "column" VALUE nulls)
SELECT "column", nulls, round(nulls * 100.0 / n * 1.000000000001, 4) + 0.0 AS null_pct
FROM l WHERE nulls > 0 ORDER BY nulls DESC, "column" LIMIT 10""")
def a10_null_report_whole(spark, sf_dir):
    """NULL report of the full-outer alignment of daily series over whole
    tables; prices of other states are NULL, so days without any are gaps."""
    o, li = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    g = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.avg(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("gold"), F.avg("o_totalprice").alias("every"))
    s = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("set"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("qty"))
    rep = S.null_report(g.join(s, "date", "full"), ["date", "gold", "every", "set", "qty"])
    return rep.withColumn("null_pct", F.round(F.col("null_pct") * F.lit(1.000000000001), 4))


_ALIGNED = """g AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS gold FROM orders GROUP BY 1),
s AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS "set"
      FROM lineitem GROUP BY 1),
j AS (SELECT date, gold, "set", CASE WHEN date >= DATE '2001-01-01' THEN gold END AS gold_roll7_mean FROM g FULL JOIN s USING (date))"""


def _aligned(spark, sf_dir):
    """Daily series over whole tables, the rolling column under its legacy name."""
    o, li = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    g = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("gold"))
    s = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.avg(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("set"))
    j = g.join(s, "date", "full")
    return rename_legacy(j.withColumn("gold_roll7", F.when(F.col("date") >= F.lit("2001-01-01").cast("date"), F.col("gold"))))


@register("q6_readiness_whole", ("Q6", "A10", "P4", "P5"), f"""
WITH {_ALIGNED},
n AS (SELECT count(*) AS n, count(*) - count(gold) AS gold, count(*) - count("set") AS "set",
             count(*) - count(gold_roll7_mean) AS gold_roll7_mean FROM j),
l AS (UNPIVOT n ON gold, "set", gold_roll7_mean INTO NAME feature VALUE nulls)
SELECT feature, CASE WHEN nulls = n THEN 'ALL_NULL' WHEN nulls * 100.0 / n > 50 THEN 'HIGH_NULL' ELSE 'OK' END AS status,
  round(nulls * 100.0 / n * 1.000000000001, 4) + 0.0 AS null_pct FROM l
UNION ALL SELECT 'gold_pct_change', 'MISSING', NULL""")
def q6_readiness_whole(spark, sf_dir):
    """Readiness of the expected features, over whole tables."""
    r = QL.readiness(_aligned(spark, sf_dir), ["gold", "set", "gold_roll7_mean", "gold_pct_change"])
    return r.withColumn("null_pct", F.round(F.col("null_pct") * F.lit(1.000000000001), 4))


@register("q2_loose_validation", ("Q2", "F18"), f"""
WITH {_ALIGNED},
a AS (SELECT count(*) - count(date) AS d, count(*) - count(gold) AS g, count(*) - count("set") AS s,
             count(*) - count(gold_roll7_mean) AS r, DATE '2001-12-31' - max(date) AS age FROM j)
SELECT 'nulls_date' AS rule, CASE WHEN d = 0 THEN 'PASS' ELSE 'WARN' END AS status, CAST(d AS VARCHAR) AS detail FROM a
UNION ALL SELECT 'nulls_gold', CASE WHEN g = 0 THEN 'PASS' ELSE 'WARN' END, CAST(g AS VARCHAR) FROM a
UNION ALL SELECT 'nulls_set', CASE WHEN s = 0 THEN 'PASS' ELSE 'WARN' END, CAST(s AS VARCHAR) FROM a
UNION ALL SELECT 'nulls_gold_roll7_mean', CASE WHEN r = 0 THEN 'PASS' ELSE 'WARN' END, CAST(r AS VARCHAR) FROM a
UNION ALL SELECT 'freshness', CASE WHEN age <= 7 THEN 'PASS' ELSE 'WARN' END, CAST(age AS VARCHAR) FROM a
UNION ALL SELECT 'required_columns', 'FAIL', 'gold_pct_change'""")
def q2_loose_validation(spark, sf_dir):
    """Required columns, NULL warnings and the age of the newest row at a
    fixed date."""
    return QL.loose_validation(_aligned(spark, sf_dir), ["date", "gold", "set", "gold_roll7_mean", "gold_pct_change"],
                               "2001-12-31")
