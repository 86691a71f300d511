"""Distributed positions: a row's 0-based index in a global (or per-group)
order without moving a whole group into one task.

The data is sorted (range partitioning spreads even one huge group over
many tasks) and checkpointed so the layout is fixed; each row's id inside
its partition plus the row counts of earlier partitions give its position.
The offset table has one row per (partition, group) segment - at most
partitions + groups rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _as_list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def global_index(df: DataFrame, order, group: Sequence[str] = (), col: str = "index") -> DataFrame:
    """Add ``col`` = 0-based position of the row in ``order`` within ``group``.

    ``order`` must be a total order (add a unique tie-break column),
    otherwise positions of tied rows are arbitrary.
    """
    order, group = _as_list(order), list(group)
    srt = df.orderBy(*group, *order).checkpoint(eager=True)
    idx = srt.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    seg = idx.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_first"))
    gw = Window.partitionBy(*group) if group else Window.partitionBy()
    seg = seg.withColumn("_before", F.coalesce(
        F.sum("_c").over(gw.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    seg = seg.select("_pid", *group, "_first", "_before")
    if group:
        from .stats import _join_null_safe
        out = _join_null_safe(idx, seg, ["_pid", *group])
    else:   # one row per partition: a proven size bound
        out = idx.join(F.broadcast(seg), ["_pid"])
    return out.withColumn(col, F.col("_before") + F.col("_mid") - F.col("_first")).drop(
        "_pid", "_mid", "_first", "_before")
