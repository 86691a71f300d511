"""Registered queries: model fitting, comparison, forecasting and
explanations (M1-M19, C5, C6).

The panel feature store has one gold series per order priority; linear
models are fitted per priority from sufficient statistics.  Single-feature
fits have a DuckDB oracle (``regr_slope`` / ``regr_intercept``); multi-
feature fits, tree models, forecasts and surrogates are checked by row
count (and by the unit tests against numpy).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..config import FeatureConfig, ForecastConfig, ModelConfig
from ..models import boosting as BO
from ..models import compare as CMP
from ..models import explain as EX
from ..models import forecast as FC
from ..models.boosting import BoostConfig
from ..models import linear as LIN
from ..operators.align import series_window
from ..operators.features import feature_columns
from ..operators.stats import attach_stats
from .feature_store import business_day_store
from .q_stats import GOLD
from .registry import register
from .series import all_series, gold_series
from .sqlgen import R

E = ("o_orderpriority",)
PANEL = FeatureConfig(entity=E)
VARS = ("gold", "fx", "cpi", "oil", "set")
FEATURES = feature_columns(VARS, PANEL)          # 25 features (no optional btc)
LABEL = "gold_next"


def panel_store(spark, sf_dir):
    series = all_series(spark, sf_dir, with_btc=False, by_priority=True)
    return business_day_store(spark, series, PANEL)


def _gold_next(spark, sf_dir):
    g = gold_series(spark, sf_dir)
    return g.withColumn(LABEL, F.lead("gold").over(series_window(E)))


_SINGLE = f"""WITH {GOLD}, n AS (SELECT *, lead(gold) OVER (PARTITION BY o_orderpriority ORDER BY date) AS gold_next FROM gold),
c AS (SELECT o_orderpriority, regr_intercept(gold_next, gold) AS intercept, regr_slope(gold_next, gold) AS slope
      FROM n WHERE gold_next IS NOT NULL GROUP BY 1)"""


@register("m1_ols_single_feature", ("M1", "A7"), f"""
{_SINGLE}
SELECT o_orderpriority, {R('intercept', 2)} AS intercept, {R('slope', 8)} AS slope FROM c""")
def m1_ols_single_feature(spark, sf_dir):
    """Next-day price on today's price per priority (OLS from sums)."""
    m = LIN.fit_linear(_gold_next(spark, sf_dir), ["gold"], LABEL, E)
    return m.select(*E, F.round(F.col("intercept") * F.lit(1.000000000001), 2).alias("intercept"),
                    F.round(F.col("coef")[0] * F.lit(1.000000000001), 8).alias("slope"))


@register("m18_batch_scoring", ("M18", "M12"), f"""
{_SINGLE}
SELECT n.o_orderpriority, n.date, {R('c.intercept + c.slope * n.gold', 2)} AS prediction
FROM n JOIN c USING (o_orderpriority)""")
def m18_batch_scoring(spark, sf_dir):
    d = _gold_next(spark, sf_dir)
    m = LIN.fit_linear(d, ["gold"], LABEL, E)
    s = LIN.score(d.select(*E, "date", "gold"), m, ["gold"], E)
    return s.select(*E, "date", F.round(F.col("prediction") * F.lit(1.000000000001), 2).alias("prediction"))


@register("m16_linear_attribution", ("M16",), f"""
{_SINGLE}, mu AS (SELECT o_orderpriority, avg(gold) AS mu FROM gold GROUP BY 1)
SELECT o_orderpriority, 'gold' AS feature, {R('avg(abs(c.slope * (g.gold - mu.mu)))', 2)} AS mean_abs_shap
FROM gold g JOIN c USING (o_orderpriority) JOIN mu USING (o_orderpriority) GROUP BY 1""")
def m16_linear_attribution(spark, sf_dir):
    """Contribution of today's price to the next-day prediction, relative
    to the mean price (background = all rows)."""
    d = _gold_next(spark, sf_dir)
    m = LIN.fit_linear(d, ["gold"], LABEL, E)
    _local, glob = EX.linear_attribution(d.select(*E, "date", "gold"), m, ["gold"], E)
    return glob.withColumn("mean_abs_shap", F.round(F.col("mean_abs_shap") * F.lit(1.000000000001), 2))


@register("m13_ar1_forecast", ("M13", "M14", "W20", "F17", "F20", "K6"), f"""
WITH RECURSIVE {_SINGLE[5:]},
last AS (SELECT o_orderpriority, max(date) AS date, arg_max(gold, date) AS gold FROM gold GROUP BY 1),
f(o_orderpriority, step, date, prev, pred) AS (
  SELECT l.o_orderpriority, 1, CASE WHEN isodow(l.date) = 6 THEN l.date + 2 ELSE l.date + 1 END, l.gold,
         c.intercept + c.slope * l.gold FROM last l JOIN c USING (o_orderpriority)
  UNION ALL
  SELECT f.o_orderpriority, f.step + 1, CASE WHEN isodow(f.date) = 6 THEN f.date + 2 ELSE f.date + 1 END, f.pred,
         c.intercept + c.slope * f.pred FROM f JOIN c USING (o_orderpriority) WHERE f.step < 7)
SELECT o_orderpriority, step, date, {R('pred', 2)} AS predicted_price, {R('pred - prev', 2)} AS change,
  {R('(pred - prev) / prev * 100', 6)} AS change_pct FROM f""")
def m13_ar1_forecast(spark, sf_dir):
    """Seven open-day recursive forecast per priority with a one-feature
    linear model (next-day price on today's price), Sunday closed."""
    d = _gold_next(spark, sf_dir)
    model = LIN.fit_linear(d, ["gold"], LABEL, E)
    latest = FC.latest_rows(d, ["date", "gold"], E)
    f = FC.recursive_forecast(latest, model, ["gold"], "gold", ForecastConfig(entity=E, horizon=7))
    nudge = F.lit(1.000000000001)
    return f.select(*E, "step", "date", F.round(F.col("predicted_price") * nudge, 2).alias("predicted_price"),
                    F.round(F.col("change") * nudge, 2).alias("change"),
                    F.round(F.col("change_pct") * nudge, 6).alias("change_pct"))


@register("m7_cv_single_feature", ("M7", "W17", "W18"), f"""
WITH {_SINGLE[5:].split(',\nc AS')[0]},
d AS (SELECT * FROM n WHERE gold_next IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY o_orderpriority) AS cnt FROM d),
tr AS (SELECT *, ntile(5) OVER (PARTITION BY o_orderpriority ORDER BY date) - 1 AS fold FROM s
       WHERE rn <= cnt - ceil(0.2 * cnt)),
folds AS (SELECT DISTINCT o_orderpriority, fold FROM tr),
m AS (SELECT f.o_orderpriority, f.fold, regr_intercept(t.gold_next, t.gold) AS a, regr_slope(t.gold_next, t.gold) AS b
      FROM folds f JOIN tr t ON t.o_orderpriority = f.o_orderpriority AND t.fold <> f.fold GROUP BY 1, 2),
e AS (SELECT t.o_orderpriority, t.fold, avg(abs(t.gold_next - (m.a + m.b * t.gold))) AS mae
      FROM tr t JOIN m USING (o_orderpriority, fold) GROUP BY 1, 2)
SELECT o_orderpriority, {R('avg(mae)', 4)} AS cv_mae, {R('stddev_pop(mae)', 4)} AS cv_std FROM e GROUP BY 1""")
def m7_cv_single_feature(spark, sf_dir):
    """5-fold contiguous CV of the one-feature OLS on the chronological
    train part, per priority (fold MAE mean and population std)."""
    d = CMP.prepare(_gold_next(spark, sf_dir), ["gold"], LABEL, ModelConfig(), E)
    cv = LIN.cross_validate(d.filter(F.col("split") == "train"), ["gold"], LABEL, "fold", E)
    nudge = F.lit(1.000000000001)
    return cv.select(*E, F.round(F.col("cv_mae") * nudge, 4).alias("cv_mae"),
                     F.round(F.col("cv_std") * nudge, 4).alias("cv_std"))


@register("m1_m3_closed_form_fits", ("M1", "M2", "M3"), f"""
WITH {GOLD},
n AS (SELECT o_orderpriority, gold AS x1, lag(gold) OVER w AS x2, lead(gold) OVER w AS y FROM gold
      WINDOW w AS (PARTITION BY o_orderpriority ORDER BY date)),
d AS (SELECT * FROM n WHERE x2 IS NOT NULL AND y IS NOT NULL),
c AS (SELECT o_orderpriority, count(*) AS n, covar_pop(x1, x1) * count(*) AS s11, covar_pop(x2, x2) * count(*) AS s22,
             covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, y) * count(*) AS s1y,
             covar_pop(x2, y) * count(*) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM d GROUP BY 1),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c)
SELECT o_orderpriority, {R('b1', 8)} AS ols_b1, {R('b2', 8)} AS ols_b2, {R('my - m1 * b1 - m2 * b2', 2)} AS ols_intercept,
  {R('s1y / (s11 + 1.0)', 8)} AS ridge_b, {R('sign(s1y) * greatest(abs(s1y) - n * 0.1, 0) / s11', 8)} AS lasso_b
FROM b""")
def m1_m3_closed_form_fits(spark, sf_dir):
    """Per priority, on rows with today's and yesterday's price and a next
    day: two-feature OLS, one-feature ridge (alpha 1) and lasso (alpha 0.1),
    all from the same partial statistics."""
    w = series_window(E)
    g = gold_series(spark, sf_dir)
    d = g.select(*E, "date", "gold", F.lag("gold").over(w).alias("x2"), F.lead("gold").over(w).alias("y"))
    d = d.filter(F.col("x2").isNotNull() & F.col("y").isNotNull()).cache()
    ols = LIN.fit_linear(d, ["gold", "x2"], "y", E).select(
        *E, F.col("coef")[0].alias("ols_b1"), F.col("coef")[1].alias("ols_b2"), F.col("intercept").alias("ols_intercept"))
    ridge = LIN.fit_linear(d, ["gold"], "y", E, (1.0,)).select(*E, F.col("coef")[0].alias("ridge_b"))
    lasso = LIN.fit_linear(d, ["gold"], "y", E, (0.1,), penalty="l1").select(*E, F.col("coef")[0].alias("lasso_b"))
    out = ols.join(ridge, list(E)).join(lasso, list(E))
    nudge = F.lit(1.000000000001)
    return out.select(*E, *[F.round(F.col(c) * nudge, 8).alias(c) for c in ("ols_b1", "ols_b2", "ridge_b", "lasso_b")],
                      F.round(F.col("ols_intercept") * nudge, 2).alias("ols_intercept"))


@register("m1_m2_linear_fit", ("M1", "M2", "P14", "P16", "J6"))
def m1_m2_linear_fit(spark, sf_dir):
    """OLS and ridge (alpha 1) on the 25-feature store, per priority:
    coefficient table (entity, alpha, feature, weight)."""
    m = LIN.fit_linear(panel_store(spark, sf_dir), FEATURES, LABEL, E, (0.0, 1.0))
    return EX.coefficient_table(m.withColumnRenamed("alpha", "_a"), FEATURES, [*E, "_a"]).withColumnRenamed(
        "_a", "alpha")


@register("m7_train_compare", ("M7", "M1", "M2", "M3", "W17", "W18", "A15", "K5"))
def m7_train_compare(spark, sf_dir):
    """Linear, ridge and lasso per priority (each with 5-fold contiguous CV)
    on a chronological 80/20 split; comparison table."""
    return CMP.train_compare(panel_store(spark, sf_dir), FEATURES, LABEL, ("linear", "ridge", "lasso"),
                             ModelConfig(), E)


def _tree_query(kind: str):
    def run(spark, sf_dir):
        return CMP.train_compare(panel_store(spark, sf_dir), FEATURES, LABEL, (kind,), ModelConfig(), E)
    run.__doc__ = f"Pooled MLlib {kind} with the reference's hyper-parameters, scored per priority."
    return run


# One query per tree model: MLlib boosting runs several Spark jobs per
# boosting iteration, so the 200/300/500-iteration configurations are kept
# as separate, individually bounded jobs.
register("m3_lasso_pooled", ("M3",))(_tree_query("lasso_pooled"))
register("m4_random_forest", ("M4",))(_tree_query("rf"))
register("m5_gradient_boosting", ("M5",))(_tree_query("gbm"))
register("m6_boosting_300", ("M6",))(_tree_query("xgb"))
register("m6_boosting_500", ("M6",))(_tree_query("lgb"))


def _boosted(spark, sf_dir, cfg: BoostConfig):
    data = CMP.prepare(panel_store(spark, sf_dir), FEATURES, LABEL, ModelConfig(), E).checkpoint()
    return CMP.boosted_compare(data, FEATURES, LABEL, cfg, "boosted", E)


# The leaf-wise variant's rates and budgets; 20 trees of its 500 (``BoostConfig``'s default)
# keep the query short: a tree with its fold models takes some 5 s of job starts whatever the rows.
LEAF_WISE = BoostConfig(trees=20, learning_rate=0.05, max_leaves=31, row_share=0.9, column_share=0.9, seed=42)


@register("m6_leaf_wise", ("M6", "M7"))
def m6_leaf_wise(spark, sf_dir):
    """Leaf-wise boosting with 31 leaves on the 25-feature store, scored per
    priority, with cross-validation over the five folds."""
    return _boosted(spark, sf_dir, LEAF_WISE)[0]


@register("m15_tree_importance", ("M15", "A19", "A21"))
def m15_tree_importance(spark, sf_dir):
    """Each feature's share of the gain of all splits, the ten largest."""
    data = panel_store(spark, sf_dir).checkpoint()
    model = BO.fit(data, FEATURES, LABEL, replace(LEAF_WISE, trees=10), row_id=[*E, "date"])
    top = model.importances()[:10]
    return spark.createDataFrame([(f, float(g), i + 1) for i, (f, g) in enumerate(top)], "feature string, importance double, rank int")


@register("m8_best_model", ("K5",))
def m8_best_model(spark, sf_dir):
    cmp = CMP.train_compare(panel_store(spark, sf_dir), FEATURES, LABEL, ("linear", "ridge"), ModelConfig(), E)
    return CMP.best_models(cmp, E)


@register("m9_grid_search", ("M9", "W18"))
def m9_grid_search(spark, sf_dir):
    """Ridge alpha grid, 5 contiguous folds from one statistics pass."""
    return CMP.grid_search(panel_store(spark, sf_dir), FEATURES, LABEL, ModelConfig(), E)


_PER = ("covar_pop(x, gold_next) * count(*) AS sxy, covar_pop(x, x) * count(*) AS sxx, avg(x) AS mx, "
        "avg(gold_next) AS my")


@register("m9_grid_search_single", ("M9", "W17", "W18", "A15"), f"""
WITH {_SINGLE[5:].split(',\nc AS')[0]},
d AS (SELECT *, gold / 10000.0 AS x FROM n WHERE gold_next IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY o_orderpriority) AS cnt FROM d),
tr AS (SELECT *, ntile(5) OVER (PARTITION BY o_orderpriority ORDER BY date) - 1 AS fold FROM s
       WHERE rn <= cnt - ceil(0.2 * cnt)),
te AS (SELECT * FROM s WHERE rn > cnt - ceil(0.2 * cnt)),
folds AS (SELECT DISTINCT o_orderpriority AS p, fold AS f FROM tr),
st AS (SELECT p AS o_orderpriority, f AS fold, {_PER} FROM folds JOIN tr ON o_orderpriority = p AND fold <> f GROUP BY 1, 2),
ta AS (SELECT tr.*, st.* EXCLUDE (o_orderpriority, fold), unnest({[float(a) for a in ModelConfig().grid_alphas]}) AS alpha
       FROM tr JOIN st USING (o_orderpriority, fold)),
e AS (SELECT o_orderpriority, fold, alpha, avg(abs(gold_next - (my + sxy / (sxx + alpha) * (x - mx)))) AS mae
      FROM ta GROUP BY 1, 2, 3),
cv AS (SELECT o_orderpriority, alpha, avg(mae) AS cv_mae FROM e GROUP BY 1, 2),
b AS (SELECT o_orderpriority, arg_min(alpha, cv_mae) AS alpha, min(cv_mae) AS cv_mae FROM cv GROUP BY 1),
ft AS (SELECT o_orderpriority, {_PER} FROM tr GROUP BY 1),
p AS (SELECT te.o_orderpriority, b.alpha, b.cv_mae, te.gold_next AS y,
             te.gold_next - (my + sxy / (sxx + b.alpha) * (te.x - mx)) AS r
      FROM te JOIN b USING (o_orderpriority) JOIN ft USING (o_orderpriority))
SELECT o_orderpriority, CAST(alpha AS DOUBLE) AS alpha, {R('cv_mae')} AS cv_mae, {R('avg(abs(r))')} AS mae,
  {R('sqrt(avg(r * r))')} AS rmse, {R('1 - sum(r * r) / (var_pop(y) * count(*))', 6)} AS r2
FROM p GROUP BY o_orderpriority, alpha, cv_mae""")
def m9_grid_search_single(spark, sf_dir):
    """Ridge alpha grid of next-day price on today's (in ten thousands) per
    priority: alpha of the least 5-fold MAE, refitted and scored on the test part."""
    d = _gold_next(spark, sf_dir).withColumn("x", F.col("gold") / 10000.0)
    g = CMP.grid_search(d, ["x"], LABEL, ModelConfig(), E)
    nudge = F.lit(1.000000000001)
    return g.select(*E, "alpha", *[F.round(F.col(c) * nudge, 4).alias(c) for c in ("cv_mae", "mae", "rmse")],
                    F.round(F.col("r2") * nudge, 6).alias("r2"))


def _forecast_inputs(spark, sf_dir):
    store = panel_store(spark, sf_dir).cache()
    model = LIN.fit_linear(store, FEATURES, LABEL, E, (1.0,))
    latest = FC.latest_rows(store, ["date", *FC.state_fields(FEATURES, "gold")], E)
    return latest, model


@register("m13_recursive_forecast", ("M13", "M14", "W20", "F14", "F16", "F17", "F20", "C6"))
def m13_recursive_forecast(spark, sf_dir):
    """7 open-day forecast per priority (Sunday closed) with the ridge model."""
    latest, model = _forecast_inputs(spark, sf_dir)
    cfg = ForecastConfig(entity=E, horizon=7)
    return FC.forecast_table(FC.recursive_forecast(latest, model, FEATURES, "gold", cfg), cfg)


@register("a25_forecast_outlook", ("A25", "F25", "M14"))
def a25_forecast_outlook(spark, sf_dir):
    """Average predicted change % of the 7-day forecast per priority and the
    outlook signal (> 0.5 up, < -0.5 down)."""
    from ..functions.labels import outlook_class
    latest, model = _forecast_inputs(spark, sf_dir)
    cfg = ForecastConfig(entity=E, horizon=7)
    f = FC.recursive_forecast(latest, model, FEATURES, "gold", cfg)
    avg = f.groupBy(*E).agg(F.avg("change_pct").alias("avg_change_pct"))
    return avg.withColumn("outlook", outlook_class("avg_change_pct"))


@register("m12_one_step", ("M12", "K6", "F17"))
def m12_one_step(spark, sf_dir):
    latest, model = _forecast_inputs(spark, sf_dir)
    return FC.one_step(latest, model, FEATURES, "gold", ForecastConfig(entity=E))


@register("m15_feature_importance", ("M15", "J6", "A19", "A20", "A21", "K4"))
def m15_feature_importance(spark, sf_dir):
    """|ridge coefficient| shares per priority, top 10."""
    model = LIN.fit_linear(panel_store(spark, sf_dir), FEATURES, LABEL, E, (1.0,))
    return EX.importance(model, FEATURES, E, top=10)


@register("m17_local_surrogate", ("M17", "K8"))
def m17_local_surrogate(spark, sf_dir):
    """Local weighted linear surrogates around each priority's newest row and
    one seeded row, 500 perturbations each, explaining the ridge model."""
    store = panel_store(spark, sf_dir).cache()
    model = LIN.fit_linear(store, FEATURES, LABEL, E, (1.0,))
    row = F.struct(*store.columns)
    per = store.groupBy(*E).agg(F.max_by(row, "date").alias("a"), F.min_by(row, F.struct(F.xxhash64("date", F.lit(42)), "date")).alias("b"))
    sample = per.select(F.explode(F.array("a", "b")).alias("r")).select("r.*").distinct()
    sample = sample.withColumn("instance", F.concat_ws("|", "o_orderpriority", F.col("date").cast("string")))
    scale = store.agg(*[F.stddev_samp(f).alias(f"_sd_{f}") for f in FEATURES])
    inst_entity = sample.select("instance", *E)
    m = model.drop("alpha")

    def scorer(pert):
        p = attach_stats(pert, inst_entity, ["instance"])
        return LIN.score(p, m, FEATURES, E)

    return EX.local_surrogate(sample, "instance", FEATURES, scorer, scale, samples=500)

