"""Train / evaluate / compare.

Every model is trained on the chronological train part (W17) and scored on
the test part; CV uses contiguous folds inside the train part (W18).  Linear
models are fitted per entity from sufficient statistics; MLlib models are
pooled.  The result is the comparison table sorted by MAE.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ModelConfig
from ..operators.split import split_and_folds
from ..operators.stats import attach_stats, regression_metrics
from . import boosting as BO
from . import linear as LIN
from . import mllib as ML
from .boosting import Boosted, BoostConfig

# name -> (penalty, alpha attribute of ModelConfig or a fixed alpha)
LINEAR_KINDS = {"linear": ("l2", 0.0), "ridge": ("l2", "ridge_alpha"), "lasso": ("l1", "lasso_alpha")}


def _alpha(cfg: ModelConfig, spec) -> float:
    return float(getattr(cfg, spec) if isinstance(spec, str) else spec)
METRIC_COLS = ["model", "mae", "mse", "rmse", "r2", "mape", "cv_mae", "cv_std"]


def prepare(df: DataFrame, features: Sequence[str], label: str, cfg: ModelConfig = ModelConfig(),
            entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """P14 complete cases -> W17 split -> W18 folds on the train part."""
    d = df.dropna(subset=[*features, label])
    return split_and_folds(d, cfg.test_fraction, cfg.folds, entity, time)


def _metrics(scored: DataFrame, label: str, name: str, entity: Sequence[str]) -> DataFrame:
    m = regression_metrics(scored.withColumnRenamed(label, "actual"), "actual", "prediction", entity)
    return m.withColumn("model", F.lit(name))


def train_compare(df: DataFrame, features: Sequence[str], label: str, models: Sequence[str] = ("linear", "ridge"),
                  cfg: ModelConfig = ModelConfig(), entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """M7 + M8: one row per (entity, model) with test metrics and CV
    mean / population std of the fold MAEs, ranked by MAE."""
    data = prepare(df, features, label, cfg, entity, time).cache()
    return compare(data, fit_all(data, features, label, models, cfg, entity), features, label, entity)


@dataclass(frozen=True)
class Fitted:
    """``linear``: (entity..., fold, model, intercept, coef) of the per-entity
    models, see ``linear.fit_with_folds``; ``pooled``: MLlib pipelines by name."""
    linear: DataFrame | None
    pooled: dict[str, PipelineModel]

    def coefficients(self) -> DataFrame:
        return self.linear.where(F.col("fold") == LIN.ALL_FOLDS).drop("fold")


def boosted_compare(data: DataFrame, features: Sequence[str], label: str, cfg: BoostConfig, name: str = "boosted",
                    entity: Sequence[str] = (), time: str = "date") -> tuple[DataFrame, Boosted]:
    """M6 + M7: the comparison row of a leaf-wise boosted model on ``prepare``'s
    rows, ``cv_mae`` and ``cv_std`` from the fold models that grow beside it."""
    train = data.filter(F.col("split") == "train")
    model = BO.fit(train, features, label, cfg, fold="fold", row_id=[*entity, time])
    m = _metrics(BO.predict(model, data.filter(F.col("split") == "test")), label, name, entity)
    held_out = BO.predict(model, train, "_p", fold="fold")
    fold_mae = held_out.groupBy(*entity, "fold").agg(F.avg(F.abs(F.col(label) - F.col("_p"))).alias("mae"))
    cv = fold_mae.groupBy(*entity).agg(F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_std"))
    return attach_stats(m, cv, entity).select(*entity, *METRIC_COLS), model


def fit_all(data: DataFrame, features: Sequence[str], label: str, models: Sequence[str], cfg: ModelConfig,
            entity: Sequence[str]) -> Fitted:
    """All models fitted on the train part of ``prepare``'s rows: the linear
    ones and their folds from one statistics pass (kept by a checkpoint, since
    scoring and validation both read them)."""
    train = data.filter(F.col("split") == "train")
    specs = {m: (LINEAR_KINDS[m][0], _alpha(cfg, LINEAR_KINDS[m][1])) for m in models if m in LINEAR_KINDS}
    linear = LIN.fit_with_folds(train, features, label, "fold", entity, specs).checkpoint() if specs else None
    return Fitted(linear, {m: ML.fit(train, features, label, "lasso" if m == "lasso_pooled" else m, cfg.seed)
                           for m in models if m not in LINEAR_KINDS})


def compare(data: DataFrame, fitted: Fitted, features: Sequence[str], label: str, entity: Sequence[str] = ()) -> DataFrame:
    """Comparison table of fitted models: test metrics, CV and rank by MAE."""
    train = data.filter(F.col("split") == "train")
    test = data.filter(F.col("split") == "test")
    out, cvs = [], []
    if fitted.linear is not None:
        coefs = fitted.coefficients()
        scored = test.join(coefs, list(entity)) if entity else _attach_all(test, coefs)
        scored = scored.withColumn("prediction", LIN.predict_expr(features)).drop("intercept", "coef")
        m = regression_metrics(scored.withColumnRenamed(label, "actual"), "actual", "prediction", [*entity, "model"])
        out.append(m)
        cvs.append(LIN.fold_errors(train, fitted.linear, features, label, "fold", entity))
    for m, model in fitted.pooled.items():
        out.append(_metrics(ML.predict(model, test), label, m, entity))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    if cvs:
        cv = cvs[0]
        for c in cvs[1:]:
            cv = cv.unionByName(c)
        res = res.join(cv, [*entity, "model"], "left")
    else:
        res = res.withColumn("cv_mae", F.lit(None).cast("double")).withColumn("cv_std", F.lit(None).cast("double"))
    w = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy("mae", "model")
    return res.select(*entity, *METRIC_COLS).withColumn("rank", F.row_number().over(w))


def _attach_all(rows: DataFrame, models: DataFrame) -> DataFrame:
    """No entity: every row meets every model; the model table has one row
    per model (a proven bound), so it is broadcast on a constant key."""
    return rows.withColumn("_one", F.lit(0)).join(F.broadcast(models.withColumn("_one", F.lit(0))), "_one").drop("_one")


def wide_predictions(data: DataFrame, fitted: Fitted, features: Sequence[str], label: str, models: Sequence[str],
                     entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """``(entity..., time, actual, <one column for each model>)`` of the
    test part.  The linear models of an entity come as one map, joined once;
    pooled models are one ``transform`` each, without a join."""
    d = data.filter(F.col("split") == "test")
    if fitted.linear is not None:
        by_name = F.map_from_entries(F.collect_list(F.struct("model", F.struct("intercept", "coef"))))
        d = attach_stats(d, fitted.coefficients().groupBy(*entity).agg(by_name.alias("_models")), entity)
    for m in models:
        if m in fitted.pooled:
            d = ML.predict(fitted.pooled[m], d, m)
        else:
            one = F.col("_models")[m]
            d = d.withColumn(m, sum((one["coef"][i] * F.col(f) for i, f in enumerate(features)), one["intercept"]))
    return d.select(*entity, time, F.col(label).alias("actual"), *models)


def best_models(comparison: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """M8: the argmin-MAE model per entity (``min_by``)."""
    return comparison.groupBy(*entity).agg(F.min_by("model", F.struct("mae", "model")).alias("best_model"),
                                           F.min("mae").alias("best_mae"))


def grid_search(df: DataFrame, features: Sequence[str], label: str, cfg: ModelConfig = ModelConfig(),
                entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """M9: ridge alpha grid with 5 contiguous folds; best alpha refitted on
    the whole train part and scored on the test part."""
    data = prepare(df, features, label, cfg, entity, time).cache()
    train = data.filter(F.col("split") == "train")
    test = data.filter(F.col("split") == "test")
    cv = LIN.cross_validate(train, features, label, "fold", entity, cfg.grid_alphas, cfg.folds)
    best = cv.groupBy(*entity).agg(F.min_by("alpha", F.struct("cv_mae", "alpha")).alias("alpha"),
                                   F.min("cv_mae").alias("cv_mae"))
    fitted = LIN.fit_linear(train, features, label, entity, cfg.grid_alphas)
    chosen = fitted.join(best.select(*entity, "alpha"), [*entity, "alpha"])
    s = LIN.score(test, chosen.drop("alpha"), features, entity)
    m = _metrics(s, label, "ridge_tuned", entity)
    return attach_stats(m, best, entity)
