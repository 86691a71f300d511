"""Pooled MLlib estimators (M3 lasso, M4 random forest, M5 gradient
boosting, M6 histogram-boosting variants) and batch scoring (M18).

These train one model over all rows with MLlib's distributed trainers
(entity is not a feature).  Per-entity linear models use
``models.linear`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame

# Hyper-parameters of the reference's model zoo.
PARAMS = {
    "lasso": {"alpha": 0.1},
    "rf": {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 3, "featureSubsetStrategy": "all"},
    "gbm": {"maxIter": 200, "maxDepth": 5, "stepSize": 0.08},
    "xgb": {"maxIter": 300, "maxDepth": 5, "stepSize": 0.06, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"},
    # Depth 5 is 32 leaves, next to the leaf budget of 31 that the original's unlimited depth has.
    "lgb": {"maxIter": 500, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"},
}


# Rows of a training task.  Trees send the statistics of every open node from
# every task and boosting takes several jobs for a tree, so few rows make few tasks.
TASK_ROWS = 1 << 16


def packed(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``train`` in tasks of some TASK_ROWS rows, as many as the rows need, in
    an order of their values, so that drawn samples don't depend on the layout."""
    d = train.select(*features, label)
    return d.repartition(max(1, -(-d.count() // TASK_ROWS)), *features, label).sortWithinPartitions(*features, label)


def estimator(kind: str, label: str, seed: int = 42, overrides: dict | None = None):
    p = dict(PARAMS[kind])
    p.update(overrides or {})
    if kind == "lasso":
        # scikit-learn's Lasso objective 1/(2n)||y - Xw||^2 + alpha ||w||_1
        # equals MLlib's with regParam = alpha and no standardisation.
        return LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=1.0,
                                regParam=p["alpha"], standardization=False, maxIter=300, tol=1e-7)
    # cacheNodeIds keeps each row's tree node between levels instead of
    # re-descending the tree every pass: same model, fewer passes' work.
    if kind == "rf":
        return RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed, cacheNodeIds=True, **p)
    return GBTRegressor(featuresCol="features", labelCol=label, seed=seed, cacheNodeIds=True, **p)


def fit(train: DataFrame, features: Sequence[str], label: str, kind: str, seed: int = 42,
        overrides: dict | None = None) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assembler, estimator(kind, label, seed, overrides)]).fit(packed(train, features, label))


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Batch scoring with a fitted pipeline."""
    scored = model.transform(df).drop("features")
    return scored.withColumnRenamed("prediction", out) if out != "prediction" else scored


def importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Tree importances or absolute lasso coefficients (one small vector
    from the fitted model, not data)."""
    m = model.stages[-1]
    vec = m.featureImportances.toArray() if hasattr(m, "featureImportances") else abs(m.coefficients.toArray())
    return [(f, float(v)) for f, v in zip(features, vec)]
