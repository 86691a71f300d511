"""Chronological train/test split (W17), contiguous folds (W18) and series
checks (W19).

Row positions come from ``row_number`` over ``partitionBy(entity)
.orderBy(time)``: after alignment an entity has one row per date, so the
window size is bounded by the calendar length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .align import series_window


def chronological_split(df: DataFrame, test_fraction: float = 0.2, entity: Sequence[str] = (),
                        time: str = "date", rule: str = "ceil_test", col: str = "split") -> DataFrame:
    """First rows -> ``train``, last rows -> ``test`` per entity.

    rule ``ceil_test``: test = ceil(f * n) (scikit-learn's split, canonical);
    ``ceil_train``: train = ceil((1 - f) * n); ``floor_train``: train = int((1 - f) * n).
    """
    w = series_window(entity, time)
    n = F.count(F.lit(1)).over(Window.partitionBy(*entity) if entity else Window.partitionBy())
    if rule == "ceil_test":
        n_train = n - F.ceil(n * F.lit(test_fraction))
    elif rule == "ceil_train":
        n_train = F.ceil(n * F.lit(1 - test_fraction))
    else:
        n_train = F.floor(n * F.lit(1 - test_fraction))
    return df.withColumn(col, F.when(F.row_number().over(w) <= n_train, "train").otherwise("test"))


def contiguous_folds(df: DataFrame, k: int = 5, entity: Sequence[str] = (), time: str = "date",
                     col: str = "fold") -> DataFrame:
    """``k`` contiguous folds in time order, larger folds first
    (13 rows -> 3,3,3,2,2), as unshuffled K-fold; 0-based ids."""
    return df.withColumn(col, F.ntile(k).over(series_window(entity, time)) - 1)


def split_and_folds(df: DataFrame, test_fraction: float = 0.2, k: int = 5, entity: Sequence[str] = (),
                    time: str = "date") -> DataFrame:
    """W17 (``ceil_test``) and W18 in one projection over one window: column
    ``split``, and ``fold`` of the train rows (NULL for test rows)."""
    d = (df.withColumn("_i", F.row_number().over(series_window(entity, time)) - 1)
         .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*entity) if entity else Window.partitionBy())))
    d = d.withColumn("_n", F.col("_n") - F.ceil(F.col("_n") * F.lit(test_fraction)))
    i, base, larger = F.col("_i"), F.floor(F.col("_n") / k), F.col("_n") % k
    # The first ``larger`` folds hold one row more.
    fold = F.when(i < larger * (base + 1), F.floor(i / (base + 1))).otherwise(
        larger + F.floor((i - larger * (base + 1)) / F.greatest(base, F.lit(1))))
    train = i < F.col("_n")
    return d.withColumns({"split": F.when(train, "train").otherwise("test"),
                          "fold": F.when(train, fold.cast("int"))}).drop("_i", "_n")


def series_checks(df: DataFrame, time: str = "date", seq: str | None = None,
                  entity: Sequence[str] = ()) -> DataFrame:
    """Is ``time`` non-decreasing in arrival order ``seq`` and unique?
    One row per entity.  Without an arrival column ``monotonic`` is NULL:
    the order of rows is not known.

    Raw rows of one entity are not ordered inside one window: each row gets
    its distributed position in ``seq`` order (``global_index``) and is
    compared with its successor through an equi-join on (entity, position),
    whose keys are unique, so a hot entity spreads over all tasks.
    """
    from .ranks import global_index
    entity = list(entity)
    counts = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("rows"),
                                     (F.count(F.lit(1)) == F.countDistinct(time)).alias("unique"))
    if seq is None:
        return counts.withColumn("monotonic", F.lit(None).cast("boolean"))
    pos = global_index(df.select(*entity, time, seq), [seq], entity, col="_pos")
    nxt = pos.select(*entity, (F.col("_pos") - 1).alias("_pos"), F.col(time).alias("_next"))
    from .stats import attach_stats, null_safe_join
    steps = null_safe_join(pos, nxt, [*entity, "_pos"], "inner")
    bad = steps.groupBy(*entity).agg(F.count_if(F.col("_next") < F.col(time)).alias("_bad"))
    out = attach_stats(counts, bad, entity)
    return out.select(*entity, (F.coalesce(F.col("_bad"), F.lit(0)) == 0).alias("monotonic"), "unique", "rows")
