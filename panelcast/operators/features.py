"""Ordered per-series features (W1-W5, W15, W16, P16, C1-C4 building blocks).

All features of one call are produced in a single projection over one
window spec, so Catalyst plans one exchange + one sort for the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..config import FeatureConfig
from .align import series_window


def lag_col(c: str, n: int, w) -> Column:
    """Value ``n`` rows earlier."""
    return F.lag(c, n).over(w)


def lead_col(c: str, n: int, w) -> Column:
    """Value ``n`` rows later (next-day target for n=1)."""
    return F.lead(c, n).over(w)


def rolling_mean_col(c: str, w, window: int = 7, min_periods: int = 3) -> Column:
    """Mean of the last ``window`` rows with at least ``min_periods`` values."""
    frame = w.rowsBetween(-(window - 1), Window.currentRow)
    return F.when(F.count(c).over(frame) >= min_periods, F.avg(c).over(frame))


def pct_change_col(c: str, w) -> Column:
    """Fractional change vs the previous row; NULL when that is 0."""
    return F.try_divide(F.col(c), F.lag(c, 1).over(w)) - F.lit(1.0)


def diff_col(c: str, w) -> Column:
    """First difference."""
    return F.col(c) - F.lag(c, 1).over(w)


def day_gap_col(time: str, w) -> Column:
    """Days since the previous row."""
    return F.datediff(F.col(time), F.lag(time, 1).over(w))


def feature_names(v: str, cfg: FeatureConfig) -> list[str]:
    return [f"{v}_lag{k}" for k in cfg.lags] + [f"{v}_{cfg.roll_name}", f"{v}_pct_change"]


def feature_columns(variables: Sequence[str], cfg: FeatureConfig, include_raw: bool = True) -> list[str]:
    """Model feature list (4 derived columns per variable, then raw)."""
    cols = [n for v in variables for n in feature_names(v, cfg)]
    return cols + (list(variables) if include_raw else [])


def add_features(df: DataFrame, cfg: FeatureConfig, variables: Sequence[str] | None = None,
                 target_next: bool = True) -> DataFrame:
    """W1-W4 per variable plus the next-day target."""
    variables = list(variables) if variables is not None else cfg.present(df.columns)
    w = series_window(cfg.entity, cfg.time)
    exprs = {}
    if target_next and cfg.target in df.columns:
        exprs[f"{cfg.target}_next"] = lead_col(cfg.target, 1, w)
    for v in variables:
        for k in cfg.lags:
            exprs[f"{v}_lag{k}"] = lag_col(v, k, w)
        exprs[f"{v}_{cfg.roll_name}"] = rolling_mean_col(v, w, cfg.roll, cfg.min_periods)
        exprs[f"{v}_pct_change"] = pct_change_col(v, w)
    return df.withColumns(exprs)


def minmax_scale(df: DataFrame, cols: Sequence[str], entity: Sequence[str] = (),
                 suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min) per entity; 0 when the range is 0.

    Per-entity min/max are a grouped aggregate joined back on the entity
    (one row per entity; a broadcast one-row aggregate without entity), not
    an unpartitioned window.
    """
    from .stats import attach_stats
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}")]
    joined = attach_stats(df, df.groupBy(*entity).agg(*aggs), entity)
    out = joined.withColumns({
        f"{c}{suffix}": F.coalesce(F.try_divide(F.col(c) - F.col(f"_min_{c}"),
                                                F.col(f"_max_{c}") - F.col(f"_min_{c}")), F.lit(0.0))
        for c in cols})
    return out.drop(*[f"_min_{c}" for c in cols], *[f"_max_{c}" for c in cols])


def minmax_inverse(scaled: Column, lo: Column, hi: Column) -> Column:
    """W16 inverse transform."""
    return scaled * (hi - lo) + lo


def sequences(df: DataFrame, cols: Sequence[str], length: int = 60, label: str | None = None,
              entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """Fixed-length samples of the previous ``length`` rows and the label
    of the current row; rows with a shorter history are dropped.

    ``label`` defaults to the first feature column, as in the reference.
    """
    label = label or cols[0]
    w = series_window(entity, time)
    frame = w.rowsBetween(-length, -1)
    seq = F.collect_list(F.array(*[F.col(c).cast("double") for c in cols])).over(frame)
    out = df.select(*entity, time, seq.alias("sequence"), F.col(label).cast("double").alias("label"))
    return out.filter(F.size("sequence") == length)


def halo_partitions(df: DataFrame, entity: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """``df`` with _pid and _halo: rows cut into ranges of (entity, order), and
    beside each range the ``k`` rows of its first entity that come before it.

    The data is sorted by (entity, order) - range partitioning splits a long
    series - and checkpointed.  A partition only needs the last K rows before
    it (K = largest lag or rolling span): those "halo" rows come from the
    last K rows of each earlier (partition, entity), numbered by a running
    count per entity; a halo row with number r belongs to the partitions
    whose preceding count c satisfies c - K < r <= c, found with an
    equi-join on (entity, r + j) for j < K - so every halo row lands in at
    most K partitions.  ``order`` must be a total order within the entity.
    """
    entity, order = list(entity), list(order)
    srt = df.orderBy(*entity, *order).checkpoint(eager=True).withColumn("_pid", F.spark_partition_id())
    ent_w = Window.partitionBy(*entity) if entity else Window.partitionBy()
    counts = srt.groupBy("_pid", *entity).agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("_c"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(
        ent_w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    seg_w = Window.partitionBy("_pid", *entity)
    tail = (srt.withColumn("_rd", F.row_number().over(seg_w.orderBy(*[F.col(o).desc() for o in order])))
            .filter(F.col("_rd") <= k))
    tail = tail.join(counts, ["_pid", *entity]).withColumn("_r", F.col("_before") + F.col("_c") - F.col("_rd") + 1)
    cand = tail.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
        "_key", F.col("_r") + F.col("_j"))
    targets = counts.filter(F.col("_before") > 0).select(
        F.col("_pid").alias("_target"), *entity, F.col("_before").alias("_key"))
    halo = (cand.join(targets, [*entity, "_key"])
            .filter(F.col("_r") > F.col("_key") - k)
            .select(*df.columns, F.col("_target").alias("_pid"), F.lit(True).alias("_halo")))
    return srt.withColumn("_halo", F.lit(False)).unionByName(halo)


def features_distributed(df: DataFrame, cols: Sequence[str], entity: Sequence[str] = (), order: Sequence[str] = ("date",),
                         lags: Sequence[int] = (1, 3), roll: int = 7, min_periods: int = 3,
                         roll_name: str = "roll7_mean") -> DataFrame:
    """W1 / W3 / W4 for series too long for one task (an entity holding most
    rows, or no entity at all), exactly equal to the window version.

    ``halo_partitions`` splits a long series; features are computed per
    (partition, entity) over halo + own rows, and halo rows are dropped.
    ``order`` must be a total order within the entity.
    """
    cols, entity, order = list(cols), list(entity), list(order)
    k = max([*lags, roll - 1, 1])
    both = halo_partitions(df, entity, order, k)
    w = Window.partitionBy("_pid", *entity).orderBy(*order)
    exprs = {}
    for c in cols:
        for lag in lags:
            exprs[f"{c}_lag{lag}"] = F.lag(c, lag).over(w)
        exprs[f"{c}_{roll_name}"] = rolling_mean_col(c, w, roll, min_periods)
        exprs[f"{c}_pct_change"] = pct_change_col(c, w)
    out = both.withColumns(exprs).filter(~F.col("_halo"))
    return out.drop("_pid", "_halo")


def sequences_distributed(df: DataFrame, cols: Sequence[str], length: int = 60, label: str | None = None,
                          entity: Sequence[str] = (), order: Sequence[str] = ("date",), batch_rows: int = 1024) -> DataFrame:
    """W15 for long series, equal to ``sequences``: ranges of rows get the
    ``length`` rows before them, and each sample is sliced from its range's
    rows as they pass, at most ``batch_rows`` samples at a time.  Rows travel
    once, not once for each sample, and one entity may lie on many tasks.
    Nulls stay nulls; ``order`` must be a total order within the entity."""
    cols, entity, order = list(cols), list(entity), list(order)
    label = label or cols[0]
    # As one struct, so that a null entity is one too.
    keys = ["_entity"] if entity else []
    at = [f"_o{i}" for i in range(len(order))]
    own = df.select(*[F.struct(*entity).alias(k) for k in keys], *[F.col(c).alias(a) for c, a in zip(order, at, strict=True)],
                    F.array(*[F.col(c).cast("double") for c in cols]).alias("_row"), F.col(label).cast("double").alias("_label"))
    w = Window.partitionBy("_pid", *keys).orderBy(*at)
    rows = (halo_partitions(own, keys, at, length).withColumn("_n", F.row_number().over(w))
            .sortWithinPartitions("_pid", *keys, *at))
    names = [*keys, *at, "sequence", "label"]
    schema = StructType([*[own.schema[c] for c in names[:-2]], StructField("sequence", ArrayType(ArrayType(DoubleType()))),
                         StructField("label", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                  # the rows that the next batch's samples may need
        for b in batches:
            values = b.column("_row") if held is None else pa.concat_arrays([held, b.column("_row")])
            before = len(values) - len(b)
            # A row numbered beyond the length has that many rows of its entity right before it.
            full = np.flatnonzero((b.column("_n").to_numpy() > length) & ~b.column("_halo").to_numpy(zero_copy_only=False))
            for i in range(0, len(full), batch_rows):
                mine = full[i:i + batch_rows]
                place = (mine[:, None] + (before - length) + np.arange(length)).ravel()
                samples = pa.ListArray.from_arrays(np.arange(len(mine) + 1, dtype=np.int32) * length, values.take(pa.array(place)))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).take(pa.array(mine)) for c in [*keys, *at]], samples, b.column("_label").take(pa.array(mine))],
                    names=names)
            held = values.slice(max(0, len(values) - length))

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("_entity")[c].alias(c) for c in entity],
                      *[F.col(a).alias(c) for c, a in zip(order, at, strict=True)], "sequence", "label")
