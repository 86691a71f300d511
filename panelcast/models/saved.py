"""Train, compare, save, and use what was saved.

One commit of a ``VersionedStore`` holds the coefficients of all linear models,
fitted pipelines, the comparison table, the best model of each entity, the
actual-against-predicted table, and the metadata record, so that a reader never
sees a comparison beside coefficients of another training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ForecastConfig, ModelConfig
from ..operators.stats import attach_stats
from ..sources.versions import VersionedStore
from . import compare as CMP
from . import forecast as FC


def train_and_save(store: VersionedStore, df: DataFrame, features: Sequence[str], label: str,
                   models: Sequence[str] = ("linear", "ridge"), cfg: ModelConfig = ModelConfig(),
                   entity: Sequence[str] = (), time: str = "date", run: str | None = None) -> int:
    """Returns the version.  ``run`` names the training; a rerun of the
    same name replaces its artefacts."""
    data = CMP.prepare(df, features, label, cfg, entity, time).persist()
    try:
        fitted = CMP.fit_all(data, features, label, models, cfg, entity)
        comparison = CMP.compare(data, fitted, features, label, entity).checkpoint()
        counts = data.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"),
                          F.max(F.when(F.col("split") == "train", F.col(time))).cast("string").alias("train_end")).first()
        items = {"comparison": comparison, "best": CMP.best_models(comparison, entity),
                 "predictions": CMP.wide_predictions(data, fitted, features, label, models, entity, time),
                 **{f"pipeline_{m}": model for m, model in fitted.pooled.items()}}
        if fitted.linear is not None:
            items["coefficients"] = fitted.coefficients()
        info = {"features": list(features), "label": label, "models": list(models), "entity": list(entity), "time": time,
                "ridge_alpha": cfg.ridge_alpha, "lasso_alpha": cfg.lasso_alpha, "test_fraction": cfg.test_fraction,
                "folds": cfg.folds, "seed": cfg.seed, **counts.asDict()}
        return store.commit(items, run=run, info=info)
    finally:
        data.unpersist()


def best_coefficients(store: VersionedStore, version: int | None = None) -> DataFrame:
    """(entity..., model, intercept, coef) of each entity's best linear model."""
    entity = store.info("best", version)["entity"]
    best = store.read("best", version).select(*entity, F.col("best_model").alias("model"))
    return store.read("coefficients", version).join(best, [*entity, "model"])


def score_saved(store: VersionedStore, df: DataFrame, version: int | None = None, out: str = "prediction") -> DataFrame:
    """Rows scored by the best saved model of their entity."""
    info = store.info("best", version)
    from . import linear as LIN
    d = attach_stats(df, best_coefficients(store, version).drop("model"), info["entity"])
    return d.withColumn(out, LIN.predict_expr(info["features"])).drop("intercept", "coef")


def forecast_saved(store: VersionedStore, rows: DataFrame, target: str, cfg: ForecastConfig,
                   version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(recursive forecast of ``cfg.horizon`` open days, one-step row) of
    each entity from its newest row and the saved best model."""
    info = store.info("best", version)
    latest = FC.latest_rows(rows, [cfg.time, *FC.state_fields(info["features"], target)], cfg.entity, cfg.time)
    model = best_coefficients(store, version).drop("model")
    many = FC.forecast_table(FC.recursive_forecast(latest, model, info["features"], target, cfg), cfg)
    return many, FC.one_step(latest, model, info["features"], target, cfg)


def save_forecast(sink: VersionedStore, many: DataFrame, one: DataFrame, run: str) -> int:
    """Both shapes of a forecast run in one commit.  Runs are parts: the
    same run written again replaces itself, others stay."""
    keyed = {name: d.withColumn("run", F.lit(run)) for name, d in (("forecast", many), ("next", one))}
    return sink.commit(keyed, run=run, part_by="run", parts=[run])
