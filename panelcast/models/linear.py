"""Linear models per entity from sufficient statistics (M1 OLS, M2 ridge,
M3 lasso, M7 cross-validation, M9 grid search, M12/M18 scoring, M17
weighted fits).

Fitting is a partial aggregation, as Spark does for ``avg``:
1. ``mapInPandas``: for each task and key (entity, or entity and fold) the
   weight total, means and *centred* cross-products of the features and
   label (numpy, vectorised), carried from batch to batch - one small row
   per key per task;
2. only these partial rows are shuffled and merged in two levels with the
   pairwise update of Chan et al. (numerically stable, no global shift
   needed): first per key and ``MERGE_BUCKETS`` hash buckets of tasks, then
   ``applyInPandas`` per entity, which also solves the k x k systems.
The last merge of an entity sees at most ``MERGE_BUCKETS`` rows per fold,
whatever the number of rows or tasks, and millions of entities solve in
parallel.  K-fold CV merges all folds but one; an alpha grid re-solves the
same statistics.

Ridge follows scikit-learn: minimise ||y - Xw - b||^2 + alpha ||w||^2 with
an unpenalised intercept.  OLS (alpha = 0) uses the pseudo-inverse, i.e. the
minimum-norm least-squares solution.  Lasso minimises
1/(2n) ||y - Xw - b||^2 + alpha ||w||_1 by coordinate descent on the same
centred statistics (covariance form), so it needs no second scan either.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.stats import attach_stats

MERGE_BUCKETS = 64      # partial rows of a key at the last merge
HELD_KEYS = 4096        # keys whose statistics a task holds before it passes them on

# Layout of a statistics vector: [n, mean_y, Cyy, mean_x (k), Cxy (k), Cxx (k*k)].


def _partial(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    n = w.sum()
    mx = (w[:, None] * x).sum(0) / n
    my = float((w * y).sum() / n)
    xc, yc = x - mx, y - my
    xw = xc * w[:, None]
    return np.concatenate([[n, my, float((w * yc * yc).sum())], mx, xw.T @ yc, (xw.T @ xc).ravel()])


def _merge(parts: Sequence[np.ndarray], k: int) -> np.ndarray:
    p = np.vstack(parts)
    n = p[:, 0]
    total = n.sum()
    my_i, mx_i = p[:, 1], p[:, 3:3 + k]
    my = (n * my_i).sum() / total
    mx = (n[:, None] * mx_i).sum(0) / total
    dx, dy = mx_i - mx, my_i - my
    cyy = p[:, 2].sum() + (n * dy * dy).sum()
    cxy = p[:, 3 + k:3 + 2 * k].sum(0) + ((n * dy)[:, None] * dx).sum(0)
    cxx = p[:, 3 + 2 * k:].sum(0).reshape(k, k) + (dx * n[:, None]).T @ dx
    return np.concatenate([[total, my, cyy], mx, cxy, cxx.ravel()])


def _lasso_cd(cxx: np.ndarray, cxy: np.ndarray, n: float, alpha: float, max_iter: int = 1000,
              tol: float = 1e-4) -> np.ndarray:
    """Lasso by cyclic coordinate descent in covariance form.

    Minimises 1/(2n) ||yc - Xc w||^2 + alpha ||w||_1 on centred data (the
    scikit-learn objective with an intercept) using only Cxx = Xc'Xc and
    Cxy = Xc'yc; stops when the largest coefficient step is below ``tol``
    times the largest coefficient, or after ``max_iter`` rounds.
    """
    k = len(cxy)
    w = np.zeros(k)
    grad = cxy.copy()                 # Cxy - Cxx w, kept up to date
    thr = n * alpha
    diag = np.diag(cxx)
    for _ in range(max_iter):
        max_step, max_w = 0.0, 0.0
        for j in range(k):
            if diag[j] <= 0:
                continue
            old = w[j]
            rho = grad[j] + diag[j] * old
            new = np.sign(rho) * max(abs(rho) - thr, 0.0) / diag[j]
            if new != old:
                grad -= cxx[:, j] * (new - old)
                w[j] = new
            max_step = max(max_step, abs(new - old))
            max_w = max(max_w, abs(new))
        if max_w == 0.0 or max_step / max_w < tol:
            break
    return w


def _solve(stats: np.ndarray, k: int, alpha: float, penalty: str = "l2") -> tuple[float, np.ndarray]:
    n, my, mx = stats[0], stats[1], stats[3:3 + k]
    cxy, cxx = stats[3 + k:3 + 2 * k], stats[3 + 2 * k:].reshape(k, k)
    if penalty == "l1" and alpha > 0:
        w = _lasso_cd(cxx, cxy, n, alpha)
    elif alpha == 0:
        w = np.linalg.pinv(cxx, rcond=1e-12) @ cxy
    else:
        w = np.linalg.solve(cxx + alpha * np.eye(k), cxy)
    return float(my - mx @ w), w


def partial_stats(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = (),
                  weight: str | None = None) -> DataFrame:
    """One row ``(keys..., stats array<double>)`` per key and bucket of tasks."""
    feats, keys = list(features), list(keys)
    cols = [*keys, *feats, label] + ([weight] if weight else [])
    d = df.select(*[F.col(c) for c in cols]).dropna(subset=[*feats, label])
    types = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    schema = ", ".join([f"`{c}` {types[c]}" for c in keys] + ["stats array<double>"])

    k = len(feats)

    def rows_of(held: dict) -> pd.DataFrame:
        return pd.DataFrame([[*key, s.tolist()] for key, s in held.items()], columns=[*keys, "stats"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            groups = pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]
            for key, g in groups:
                x = g[feats].to_numpy(dtype=float)
                y = g[label].to_numpy(dtype=float)
                w = g[weight].to_numpy(dtype=float) if weight else np.ones(len(g))
                key = tuple(None if pd.isna(v) else v for v in (key if isinstance(key, tuple) else (key,)))
                s = _partial(x, y, w)
                held[key] = _merge([held[key], s], k) if key in held else s
            if len(held) > HELD_KEYS:
                yield rows_of(held)
                held = {}
        if held:
            yield rows_of(held)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        key = [None if pd.isna(pdf.iloc[0][c]) else pdf.iloc[0][c] for c in keys]
        return pd.DataFrame([[*key, _merge([np.asarray(s) for s in pdf["stats"]], k).tolist()]], columns=[*keys, "stats"])

    parts = d.mapInPandas(run, schema).withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(MERGE_BUCKETS)))
    return parts.groupBy(*keys, "_bucket").applyInPandas(merge, schema)


def _model_schema(df: DataFrame, keys: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join([f"`{c}` {types[c]}" for c in keys] + ["alpha double", "intercept double", "coef array<double>"])


def fit_linear(df: DataFrame, features: Sequence[str], label: str, entity: Sequence[str] = (),
               alphas: Sequence[float] = (0.0,), weight: str | None = None, penalty: str = "l2") -> DataFrame:
    """M1 (alpha 0), M2 (ridge, ``penalty='l2'``) and M3 (lasso,
    ``penalty='l1'``) per entity: ``(entity..., alpha, intercept, coef array)``."""
    k, entity = len(features), list(entity)
    parts = partial_stats(df, features, label, entity, weight)
    keyed = parts if entity else parts.withColumn("_one", F.lit(0))
    schema = _model_schema(parts, entity)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        merged = _merge([np.asarray(s) for s in pdf["stats"]], k)
        key = [pdf.iloc[0][c] for c in entity]
        rows = []
        for a in alphas:
            b, w = _solve(merged, k, float(a), penalty)
            rows.append([*key, float(a), b, w.tolist()])
        return pd.DataFrame(rows, columns=[*entity, "alpha", "intercept", "coef"])

    return keyed.groupBy(*(entity or ["_one"])).applyInPandas(fit, schema)


def predict_expr(features: Sequence[str], coef: str = "coef", intercept: str = "intercept") -> Column:
    """``intercept + sum(coef[i] * x_i)`` as a Catalyst expression."""
    return sum((F.col(coef)[i] * F.col(f) for i, f in enumerate(features)), F.col(intercept))


def score(df: DataFrame, model: DataFrame, features: Sequence[str], entity: Sequence[str] = (),
          out: str = "prediction") -> DataFrame:
    """Batch scoring - join the per-entity model, evaluate the linear
    expression (AQE broadcasts the model table when it is small)."""
    j = attach_stats(df, model.drop("alpha") if "alpha" in model.columns else model, entity)
    return j.withColumn(out, predict_expr(features)).drop("intercept", "coef")


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold",
                   entity: Sequence[str] = (), alphas: Sequence[float] = (0.0,), k: int = 5,
                   penalty: str = "l2") -> DataFrame:
    """M7/M9: K-fold CV for every alpha from one statistics pass.

    Partial statistics per (entity, fold); per entity the model for held-out
    fold f merges the other folds.  The held-out MAE needs one scoring pass
    joined on (entity, fold).  Returns (entity..., alpha, cv_mae, cv_std)
    with the population std of the fold MAEs, as the reference reports.
    """
    nf, entity = len(features), list(entity)
    d = df.dropna(subset=[*features, label, fold])
    parts = partial_stats(d, features, label, [*entity, fold])
    keyed = parts if entity else parts.withColumn("_one", F.lit(0))
    schema = _model_schema(parts, [*entity, fold])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        key = [pdf.iloc[0][c] for c in entity]
        by_fold = {f: _merge([np.asarray(s) for s in g["stats"]], nf) for f, g in pdf.groupby(fold)}
        rows = []
        for f in by_fold:
            others = [s for g, s in by_fold.items() if g != f]
            if not others:
                continue
            train = _merge(others, nf)
            for a in alphas:
                b, w = _solve(train, nf, float(a), penalty)
                rows.append([*key, f, float(a), b, w.tolist()])
        return pd.DataFrame(rows, columns=[*entity, fold, "alpha", "intercept", "coef"])

    models = keyed.groupBy(*(entity or ["_one"])).applyInPandas(fit, schema)
    scored = d.join(models, [*entity, fold])
    err = F.abs(F.col(label) - predict_expr(features))
    fold_mae = scored.groupBy(*entity, "alpha", fold).agg(F.avg(err).alias("mae"))
    return fold_mae.groupBy(*entity, "alpha").agg(F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_std"))


def _specs_schema(df: DataFrame, keys: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join([f"`{c}` {types[c]}" for c in keys] +
                     ["model string", "intercept double", "coef array<double>"])


def fit_models(df: DataFrame, features: Sequence[str], label: str, entity: Sequence[str] = (),
               specs: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """Several linear models from ONE statistics pass:
    ``specs = {name: (penalty, alpha)}`` -> ``(entity..., model, intercept, coef)``."""
    specs = specs or {"linear": ("l2", 0.0)}
    k, entity = len(features), list(entity)
    parts = partial_stats(df, features, label, entity)
    keyed = parts if entity else parts.withColumn("_one", F.lit(0))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        merged = _merge([np.asarray(s) for s in pdf["stats"]], k)
        key = [pdf.iloc[0][c] for c in entity]
        rows = []
        for name, (penalty, a) in specs.items():
            b, w = _solve(merged, k, float(a), penalty)
            rows.append([*key, name, b, w.tolist()])
        return pd.DataFrame(rows, columns=[*entity, "model", "intercept", "coef"])

    return keyed.groupBy(*(entity or ["_one"])).applyInPandas(fit, _specs_schema(parts, entity))


ALL_FOLDS = -1


def fit_with_folds(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold", entity: Sequence[str] = (),
                   specs: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """``fit_models`` and the models of all folds but one, from ONE statistics
    pass: ``(entity..., fold, model, intercept, coef)``, with fold
    ``ALL_FOLDS`` for the fit on all rows (the merge of the folds)."""
    specs = specs or {"linear": ("l2", 0.0)}
    nf, entity = len(features), list(entity)
    parts = partial_stats(df.dropna(subset=[*features, label, fold]), features, label, [*entity, fold])
    keyed = parts if entity else parts.withColumn("_one", F.lit(0))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        key = [pdf.iloc[0][c] for c in entity]
        by_fold = {f: _merge([np.asarray(s) for s in g["stats"]], nf) for f, g in pdf.groupby(fold)}
        rows = []
        for f in [ALL_FOLDS, *by_fold]:
            used = [s for g, s in by_fold.items() if g != f]
            if used:
                train = _merge(used, nf)
                for name, (penalty, a) in specs.items():
                    b, w = _solve(train, nf, float(a), penalty)
                    rows.append([*key, f, name, b, w.tolist()])
        return pd.DataFrame(rows, columns=[*entity, fold, "model", "intercept", "coef"])

    return keyed.groupBy(*(entity or ["_one"])).applyInPandas(fit, _specs_schema(parts, [*entity, fold]))


def fold_errors(df: DataFrame, models: DataFrame, features: Sequence[str], label: str, fold: str = "fold",
                entity: Sequence[str] = ()) -> DataFrame:
    """``(entity..., model, cv_mae, cv_std)``: the held-out rows scored by the
    models of ``fit_with_folds`` in one pass."""
    scored = df.dropna(subset=[*features, label, fold]).join(models, [*entity, fold])
    err = F.abs(F.col(label) - predict_expr(features))
    fold_mae = scored.groupBy(*entity, "model", fold).agg(F.avg(err).alias("mae"))
    return fold_mae.groupBy(*entity, "model").agg(F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_std"))


def cross_validate_models(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold",
                          entity: Sequence[str] = (), specs: dict[str, tuple[str, float]] | None = None
                          ) -> DataFrame:
    """K-fold CV of several linear models from ONE statistics pass and ONE
    scoring pass: ``(entity..., model, cv_mae, cv_std)``."""
    specs = specs or {"linear": ("l2", 0.0)}
    nf, entity = len(features), list(entity)
    d = df.dropna(subset=[*features, label, fold])
    parts = partial_stats(d, features, label, [*entity, fold])
    keyed = parts if entity else parts.withColumn("_one", F.lit(0))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        key = [pdf.iloc[0][c] for c in entity]
        by_fold = {f: _merge([np.asarray(s) for s in g["stats"]], nf) for f, g in pdf.groupby(fold)}
        rows = []
        for f in by_fold:
            others = [s for g, s in by_fold.items() if g != f]
            if not others:
                continue
            train = _merge(others, nf)
            for name, (penalty, a) in specs.items():
                b, w = _solve(train, nf, float(a), penalty)
                rows.append([*key, f, name, b, w.tolist()])
        return pd.DataFrame(rows, columns=[*entity, fold, "model", "intercept", "coef"])

    models = keyed.groupBy(*(entity or ["_one"])).applyInPandas(fit, _specs_schema(parts, [*entity, fold]))
    scored = d.join(models, [*entity, fold])
    err = F.abs(F.col(label) - predict_expr(features))
    fold_mae = scored.groupBy(*entity, "model", fold).agg(F.avg(err).alias("mae"))
    return fold_mae.groupBy(*entity, "model").agg(F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_std"))
