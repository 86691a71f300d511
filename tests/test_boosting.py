"""Leaf-wise boosting against a plain grower that looks at one leaf at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import boosting as B

FEATURES = ["a", "b", "c"]


def _data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, n).astype(float), rng.standard_normal(n), rng.integers(0, 2, n).astype(float)], 1)
    y = x[:, 0] * 2 + np.sin(3 * x[:, 1]) * 4 + x[:, 2] * x[:, 0] + rng.standard_normal(n) * 0.1
    return x, y, np.arange(n) * 5 // n


def _frame(spark, x, y, fold):
    rows = [(i, *map(float, r), float(v), int(f)) for i, (r, v, f) in enumerate(zip(x, y, fold, strict=True))]
    return spark.createDataFrame(rows, "i long, a double, b double, c double, y double, fold int").repartition(5)


def _plain(bins, y, ids, cfg, width):
    """Boosting with one leaf split at a time, histograms of each child computed anew."""
    start = y.mean()
    residual, out = y - start, []
    for t in range(cfg.trees):
        drawn = B._drawn(ids, t, cfg.row_share, cfg.seed)
        columns = B.columns_of(t, bins.shape[1], cfg.column_share, cfg.seed)
        leaves = [(np.ones(len(y), bool), 0)]

        def split(mask):
            use = mask & drawn
            return B.best_split(B.histogram(bins[use], residual[use], np.zeros(use.sum(), int), 1, width)[0], columns, cfg)
        while len(leaves) < cfg.max_leaves:
            able = [(s[0], k, s) for k, (m, d) in enumerate(leaves)
                    if not (cfg.max_depth and d >= cfg.max_depth) and (s := split(m))]
            if not able:
                break
            _gain, k, (_, f, b) = max(able, key=lambda v: v[0])
            m, d = leaves.pop(k)
            left = m & (bins[:, f] <= b)
            leaves += [(left, d + 1), (m & ~left, d + 1)]
        step = np.zeros(len(y))
        for m, _ in leaves:
            use = m & drawn
            step[m] = cfg.learning_rate * residual[use].sum() / (use.sum() + cfg.l2)
        out.append(step)
        residual = residual - step
    return start + sum(out)


@pytest.mark.parametrize("cfg", [
    B.BoostConfig(trees=6, max_leaves=8, min_leaf_rows=5, row_share=1.0, column_share=1.0, learning_rate=0.3),
    B.BoostConfig(trees=5, max_leaves=31, min_leaf_rows=3, row_share=0.8, column_share=0.7, learning_rate=0.2, l2=1.0),
    B.BoostConfig(trees=4, max_leaves=12, max_depth=3, min_leaf_rows=10)])
def test_equals_a_plain_grower(spark, cfg):
    x, y, fold = _data()
    d = _frame(spark, x, y, fold)
    model = B.fit(d, FEATURES, "y", cfg, row_id=["i"])
    bins = B.binned(x, model.edges)
    ids = np.array([r.h for r in spark.range(len(y)).select("id", F.xxhash64("id").alias("h")).orderBy("id").collect()], np.int64)
    want = _plain(bins, y, ids, cfg, max(map(len, model.edges)) + 1)
    got = {r.i: r.prediction for r in B.predict(model, d).collect()}
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-9)
    assert all(sum(f < 0 for f in t.feature) >= 2 for _, trees in model.models.values() for t in trees)
    assert abs(sum(v for _, v in model.importances()) - 1) < 1e-9


def test_folds_share_the_pass_and_stay_apart(spark):
    """A fold's model equals one fitted on the rows of the others alone."""
    x, y, fold = _data(300, 2)
    d = _frame(spark, x, y, fold)
    cfg = B.BoostConfig(trees=4, max_leaves=6, min_leaf_rows=5, row_share=0.9, column_share=1.0, learning_rate=0.3)
    model = B.fit(d, FEATURES, "y", cfg, fold="fold", row_id=["i"])
    assert sorted(model.models) == [-1, 0, 1, 2, 3, 4]
    bins = B.binned(x, model.edges)
    ids = np.array([r.h for r in spark.range(len(y)).select("id", F.xxhash64("id").alias("h")).orderBy("id").collect()], np.int64)
    held_out = {r.i: r.prediction for r in B.predict(model, d, fold="fold").collect()}
    width = max(map(len, model.edges)) + 1
    for f in range(5):
        use = fold != f
        step = _plain(bins[use], y[use], ids[use], cfg, width)
        start, trees = model.models[f]
        assert np.allclose(start + sum(t.predict(bins[use]) for t in trees), step, atol=1e-9)
        assert all(abs(held_out[i] - (start + sum(t.predict(bins[i:i + 1])[0] for t in trees))) < 1e-9 for i in np.flatnonzero(~use))


def test_jobs_for_each_tree_are_bounded(spark):
    """Rounds follow the depth of a tree, not its leaves."""
    x, y, fold = _data(500, 3)
    calls = []
    plain = B._pass
    cfg = B.BoostConfig(trees=5, max_leaves=31, min_leaf_rows=5, row_share=1.0)
    try:
        B._pass = lambda *a: calls.append(a[2]) or plain(*a)
        model = B.fit(_frame(spark, x, y, fold), FEATURES, "y", cfg, row_id=["i"])
    finally:
        B._pass = plain
    for t, tree in enumerate(model.models[-1][1]):
        leaves = sum(f < 0 for f in tree.feature)
        assert calls.count(t) <= max(tree.depth) + 2 < leaves


def test_empty_and_constant(spark):
    x, y, fold = _data(40, 4)
    d = _frame(spark, x, y, fold)
    cfg = B.BoostConfig(trees=2, min_leaf_rows=1)
    assert B.predict(B.fit(d.limit(0), FEATURES, "y", cfg, row_id=["i"]), d).where("prediction <> 0").count() == 0
    flat = B.fit(d.withColumn("y", F.lit(3.0)), FEATURES, "y", cfg, row_id=["i"])
    assert {r.prediction for r in B.predict(flat, d).collect()} == {3.0}
    gap = B.predict(flat, d.withColumn("a", F.when(F.col("i") > 3, F.col("a"))))
    assert gap.where("prediction IS NULL").count() == 4
