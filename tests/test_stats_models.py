"""Aggregations, monitoring and models against brute force (numpy)."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, MonitorConfig
from panelcast.models import forecast as FC
from panelcast.models import linear as LIN
from panelcast.models import mllib as ML
from panelcast.operators import stats as S
from panelcast.operators.monitor import monitoring_report
from panelcast.operators.ranks import global_index

D0 = dt.date(2024, 1, 1)


def test_exact_percentiles_skewed_group(spark):
    rng = random.Random(1)
    # one group holds most rows (the hot key), others are small
    rows = [("hot", rng.gauss(0, 1)) for _ in range(3000)] + [(g, rng.random()) for g in "abc" for _ in range(37)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: (r.p50, r.p95, r.p99) for r in S.exact_percentiles(df, "v", (0.5, 0.95, 0.99), ["g"]).collect()}
    for g in ("hot", "a", "b", "c"):
        vals = np.array([v for k, v in rows if k == g])
        exp = np.percentile(vals, [50, 95, 99])
        assert np.allclose(got[g], exp, rtol=0, atol=1e-12)


def test_global_index_matches_sort(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000).repartition(5)
    rows = global_index(df, "k").collect()
    assert sorted((r.k, r["index"]) for r in rows) == [(i, i) for i in range(1000)]


def test_regression_metrics_constant_series(spark):
    df = spark.createDataFrame([(5.0, 5.0)] * 4, "actual double, predicted double")
    r = S.regression_metrics(df).first()
    assert r.mae == 0 and r.r2 == 1.0 and r.accuracy == 100.0


def test_outlier_support_guard(spark):
    base = [float(i) for i in range(10)]
    ten = spark.createDataFrame([(v,) for v in base], "v double")
    eleven = spark.createDataFrame([(v,) for v in base + [1e6]], "v double")
    assert S.outlier_flags(ten, "v").filter("is_outlier").count() == 0
    assert S.outlier_flags(eleven, "v").filter("is_outlier").count() == 1


def _panel(n=120, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for e, (a, b1, b2) in {"x": (1.0, 2.0, -1.0), "y": (-3.0, 0.5, 4.0)}.items():
        for i in range(n):
            x1, x2 = rng.normal(size=2) * [10, 3]
            rows.append((e, D0 + dt.timedelta(days=i), float(x1), float(x2),
                         float(a + b1 * x1 + b2 * x2 + rng.normal() * 0.1)))
    return rows


def test_linear_fit_matches_numpy(spark):
    rows = _panel()
    df = spark.createDataFrame(rows, "e string, date date, x1 double, x2 double, y double").repartition(4)
    got = {(r.e, r.alpha): (r.intercept, r.coef) for r in LIN.fit_linear(df, ["x1", "x2"], "y", ["e"], (0.0, 5.0)).collect()}
    for e in ("x", "y"):
        X = np.array([[r[2], r[3]] for r in rows if r[0] == e])
        y = np.array([r[4] for r in rows if r[0] == e])
        A = np.c_[np.ones(len(X)), X]
        ols = np.linalg.lstsq(A, y, rcond=None)[0]
        assert np.allclose([got[(e, 0.0)][0], *got[(e, 0.0)][1]], ols, atol=1e-8)
        xc, yc = X - X.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(2), xc.T @ yc)
        assert np.allclose(got[(e, 5.0)][1], w, atol=1e-8)
        assert np.isclose(got[(e, 5.0)][0], y.mean() - X.mean(0) @ w, atol=1e-8)


def test_cross_validate_matches_loop(spark):
    rows = _panel(50)
    df = spark.createDataFrame(rows, "e string, date date, x1 double, x2 double, y double")
    from panelcast.operators.split import contiguous_folds
    f = contiguous_folds(df, 5, ["e"])
    got = {r.e: (r.cv_mae, r.cv_std) for r in LIN.cross_validate(f, ["x1", "x2"], "y", "fold", ["e"]).collect()}
    for e in ("x", "y"):
        data = [r for r in rows if r[0] == e]
        X = np.array([[r[2], r[3]] for r in data])
        y = np.array([r[4] for r in data])
        folds = np.array_split(np.arange(len(y)), 5)
        maes = []
        for idx in folds:
            tr = np.setdiff1d(np.arange(len(y)), idx)
            A = np.c_[np.ones(len(tr)), X[tr]]
            b = np.linalg.lstsq(A, y[tr], rcond=None)[0]
            maes.append(np.abs(y[idx] - np.c_[np.ones(len(idx)), X[idx]] @ b).mean())
        assert np.isclose(got[e][0], np.mean(maes), atol=1e-9) and np.isclose(got[e][1], np.std(maes), atol=1e-9)


def test_recursive_forecast_matches_loop(spark):
    feats = ["gold", "gold_lag1", "gold_lag3", "fx"]
    latest = spark.createDataFrame([("a", dt.date(2025, 11, 21), 100.0, 99.0, 97.0, 30.0)],
                                   "e string, date date, gold double, gold_lag1 double, gold_lag3 double, fx double")
    model = spark.createDataFrame([("a", 1.0, [0.5, 0.3, 0.1, 0.2])], "e string, intercept double, coef array<double>")
    cfg = ForecastConfig(entity=("e",), horizon=3)
    got = FC.recursive_forecast(latest, model, feats, "gold", cfg).orderBy("step").collect()
    state = {"gold": 100.0, "gold_lag1": 99.0, "gold_lag3": 97.0, "fx": 30.0}
    d = dt.date(2025, 11, 21)
    exp = []
    for _ in range(3):
        p = 1.0 + 0.5 * state["gold"] + 0.3 * state["gold_lag1"] + 0.1 * state["gold_lag3"] + 0.2 * state["fx"]
        d = d + dt.timedelta(days=1)
        while d.weekday() == 6:
            d = d + dt.timedelta(days=1)
        exp.append((d, p, p - state["gold"]))
        # lag3 keeps its value (lag2 absent); lag1 <- gold; gold <- prediction
        state = {"gold": p, "gold_lag1": state["gold"], "gold_lag3": state["gold_lag3"], "fx": state["fx"]}
    assert [r.date for r in got] == [e[0] for e in exp]
    assert [r.predicted_price for r in got] == pytest.approx([e[1] for e in exp])
    assert [r.change for r in got] == pytest.approx([e[2] for e in exp])
    assert [r.date for r in got] == [dt.date(2025, 11, 22), dt.date(2025, 11, 24), dt.date(2025, 11, 25)]


def test_monitoring_short_history(spark):
    one = spark.createDataFrame([(D0, 100.0, 99.0)], "date date, actual double, predicted double")
    r = monitoring_report(one, MonitorConfig()).first()
    assert r.decay_rate_7d == 0.0 and r.is_declining_7d is True and r.speed == "N/A"


def test_monitoring_report_matches_pandas(spark):
    rng = np.random.default_rng(42)
    actual = 100 + rng.normal(size=50).cumsum()
    pred = actual + rng.normal(size=50)
    rows = [(D0 + dt.timedelta(days=i), float(a), float(p)) for i, (a, p) in enumerate(zip(actual, pred))]
    r = monitoring_report(spark.createDataFrame(rows, "date date, actual double, predicted double")).first()
    acc = 100 - np.abs((actual - pred) / actual) * 100
    m7 = np.array([acc[max(0, i - 6):i + 1].mean() for i in range(50)])
    assert np.isclose(r.current_7d, m7[-1]) and np.isclose(r.decay_rate_7d, m7[-2] - m7[-1])
    assert r.is_declining_7d == bool(all(m7[-5:][i] > m7[-5:][i + 1] for i in range(4)))
    assert np.isclose(r.variance, np.var(m7[-10:], ddof=1))
    assert np.isclose(r.slope, np.polyfit(np.arange(10), m7[-10:], 1)[0])
    assert np.isclose(r.balance_index, ((pred > actual).sum() - (pred < actual).sum()) / 50)


def test_lasso_kkt_conditions(spark):
    rows = _panel(200, seed=5)
    df = spark.createDataFrame(rows, "e string, date date, x1 double, x2 double, y double")
    alpha = 0.5
    got = {r.e: (r.intercept, r.coef) for r in LIN.fit_linear(df, ["x1", "x2"], "y", ["e"], (alpha,),
                                                                penalty="l1").collect()}
    for e in ("x", "y"):
        X = np.array([[r[2], r[3]] for r in rows if r[0] == e])
        y = np.array([r[4] for r in rows if r[0] == e])
        n = len(y)
        w = np.array(got[e][1])
        xc, yc = X - X.mean(0), y - y.mean()
        g = xc.T @ (yc - xc @ w) / n            # subgradient condition of the lasso objective
        for j in range(2):
            if w[j] != 0:
                assert abs(g[j] - alpha * np.sign(w[j])) < 1e-3
            else:
                assert abs(g[j]) <= alpha + 1e-6
        assert np.isclose(got[e][0], y.mean() - X.mean(0) @ w)


def test_exact_percentiles_null_group(spark):
    rows = [(None, float(i)) for i in range(11)] + [("a", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.p50 for r in S.exact_percentiles(df, "v", (0.5,), ["g"]).collect()}
    assert got == {None: 5.0, "a": 2.0}


def test_approx_percentiles_close_to_exact(spark):
    rng = random.Random(3)
    rows = [("g", rng.gauss(0, 1)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g string, v double")
    approx = S.measurement_summary(df, "v", ["g"], exact=False).first()
    vals = np.sort([v for _, v in rows])
    for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        # rank error of the sketch is about n / accuracy
        lo, hi = vals[max(0, int(p * 5000) - 2)], vals[min(4999, int(p * 5000) + 2)]
        assert lo <= approx[name] <= hi


def test_training_rows_make_few_tasks_in_an_order_of_their_own(spark, monkeypatch):
    rows = [(float(i % 7), float(i * 37 % 101), float(i)) for i in range(300)]
    d = spark.createDataFrame(rows, "a double, b double, y double")
    one = ML.packed(d.repartition(13), ["a", "b"], "y")
    assert one.rdd.getNumPartitions() == 1
    assert one.collect() == ML.packed(d.repartition(3), ["a", "b"], "y").collect() and one.count() == 300
    assert ML.packed(d.limit(0), ["a", "b"], "y").count() == 0
    monkeypatch.setattr(ML, "TASK_ROWS", 100)
    assert ML.packed(d, ["a", "b"], "y").rdd.getNumPartitions() == 3
