"""Model explanations (M15 importance, M16 linear attribution, M17 local
surrogate, J6 feature x weight zip)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stats import attach_stats
from . import linear as LIN


def coefficient_table(model: DataFrame, features: Sequence[str], entity: Sequence[str] = ()) -> DataFrame:
    """``(entity..., feature, weight)`` by zipping names with the
    coefficient array."""
    names = F.array(*[F.lit(f) for f in features])
    z = F.arrays_zip(names.alias("feature"), F.col("coef").alias("weight"))
    return model.select(*entity, F.inline(z))


def importance(model: DataFrame, features: Sequence[str], entity: Sequence[str] = (), top: int | None = None
               ) -> DataFrame:
    """|coefficient| as importance, share of total in percent
    and rank per entity; ``top`` keeps the first n (K4)."""
    t = coefficient_table(model, features, entity).withColumn("importance", F.abs("weight"))
    w = Window.partitionBy(*entity) if entity else Window.partitionBy()
    t = t.withColumn("importance_pct", F.col("importance") / F.sum("importance").over(w) * 100)
    t = t.withColumn("rank", F.row_number().over(w.orderBy(F.col("importance").desc(), "feature")))
    return t.filter(F.col("rank") <= top) if top else t


def linear_attribution(df: DataFrame, model: DataFrame, features: Sequence[str], entity: Sequence[str] = (),
                       background: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Per-row contribution ``coef_j * (x_j - mean_j)`` with means over
    the background set (default: ``df``), and the global importance
    ``mean |contribution|`` per feature.  Returns (local long, global)."""
    bg = background if background is not None else df
    means = bg.groupBy(*entity).agg(*[F.avg(f).alias(f"_mu_{f}") for f in features])
    j = attach_stats(attach_stats(df, means, entity), model.drop("alpha") if "alpha" in model.columns else model,
                     entity)
    contrib = F.array(*[F.struct(F.lit(f).alias("feature"),
                                 (F.col("coef")[i] * (F.col(f) - F.col(f"_mu_{f}"))).alias("shap"))
                        for i, f in enumerate(features)])
    keep = [c for c in df.columns if c not in features]
    local = j.select(*keep, F.inline(contrib))
    glob = local.groupBy(*entity, "feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
    return local, glob


def _uniform(*parts: Column) -> Column:
    """Partition-independent uniform in (0, 1) from a hash of the parts."""
    h = F.xxhash64(*parts)
    return ((F.pmod(h, F.lit(1 << 52)) + F.lit(0.5)) / float(1 << 52))


def _normal(*parts: Column) -> Column:
    u1 = _uniform(*parts, F.lit(1))
    u2 = _uniform(*parts, F.lit(2))
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * math.pi * u2)


def local_surrogate(instances: DataFrame, key: str, features: Sequence[str], scorer, scale: DataFrame,
                    samples: int = 500, width: float | None = None, seed: int = 42, top: int = 10) -> DataFrame:
    """For each instance, ``samples`` Gaussian perturbations (std per
    feature from ``scale``), scored by ``scorer(df) -> df with
    'prediction'``, weighted by an exponential kernel on the standardised
    distance, and a weighted linear fit per instance from weighted
    sufficient statistics.  Random numbers come from hashes of (instance,
    sample, feature, seed), so results do not depend on partitioning.
    Returns the ``top`` features by |local weight| per instance.
    """
    k = len(features)
    width = width or 0.75 * math.sqrt(k)
    ex = instances.select(key, *features).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    ex = attach_stats(ex, scale)
    z = {f: F.when(F.col("_s") == 0, F.lit(0.0)).otherwise(_normal(F.col(key), F.col("_s"), F.lit(i), F.lit(seed)))
         for i, f in enumerate(features)}
    pert = ex.select(key, "_s", *[(F.col(f) + z[f] * F.col(f"_sd_{f}")).alias(f) for f in features],
                     *[z[f].alias(f"_z_{f}") for f in features])
    dist = F.sqrt(sum((F.col(f"_z_{f}") ** 2 for f in features), F.lit(0.0)))
    pert = pert.withColumn("_w", F.sqrt(F.exp(-(dist ** 2) / (width ** 2))))
    scored = scorer(pert)
    fitted = LIN.fit_linear(scored.withColumn("_y", F.col("prediction")), features, "_y", [key], (1.0,), weight="_w")
    imp = importance(fitted, features, [key], top)
    return imp.select(key, "feature", "weight", "rank")
