"""Keyed deduplication (W9, W10, S10) and last-tick-per-day (A2).

Both are written as aggregations, not ``row_number`` windows: a hot key that
holds a third of all rows is then reduced map-side (partial aggregation)
before the shuffle instead of being sorted in one task.  The survivor is
chosen by an explicit, total order (sequence columns, then every remaining
column), so the result does not depend on file or partition order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def dedupe(df: DataFrame, key, order, keep: str = "last", where: Column | None = None) -> DataFrame:
    """Keep one row per ``key``: the one with the greatest (``keep='last'``)
    or smallest (``keep='first'``) ``order``.

    W9 is ``keep='last'`` in arrival order, W10 ``keep='first'``.  Arrival
    order must be a column (a timestamp or a source row id).  Rows tied on
    ``order`` are resolved by the remaining columns, deterministically.

    ``where`` keeps only qualifying rows.  It is applied inside the
    aggregate (``max(when(where, row))``) rather than as a Filter in front
    of it: a Filter would be pushed down through the projections and inline
    expensive derived columns (e.g. a parsed date) a second time.
    """
    key, order = _as_list(key), _as_list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    if where is not None:
        packed = F.when(where, packed)
    agg = F.max(packed) if keep == "last" else F.min(packed)
    out = df.groupBy(*key).agg(agg.alias("_row"))
    if where is not None:
        out = out.filter(F.col("_row").isNotNull())
    return out.select(*key, *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(*df.columns)


def last_non_null_per_group(df: DataFrame, group: Sequence[str], order, value_cols: Sequence[str]) -> DataFrame:
    """A2: per group, the last non-null value of each column by ``order``.

    ``max_by(v, order) FILTER (WHERE v IS NOT NULL)`` per column, as pandas'
    ``groupby().last()`` skips nulls column by column.
    """
    order = _as_list(order)
    ordering = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    aggs = []
    for v in value_cols:
        present = F.col(v).isNotNull()
        aggs.append(F.max_by(F.when(present, F.col(v)), F.when(present, ordering)).alias(v))
    return df.groupBy(*group).agg(*aggs)


def drop_last_row(df: DataFrame, order, entity: Sequence[str] = ()) -> DataFrame:
    """Drop the final row (by ``order``) of each entity.

    The last key per entity is an aggregate; an anti-join removes it.
    """
    order = _as_list(order)
    ordering = F.struct(*[F.col(c) for c in order])
    if entity:
        last = df.groupBy(*entity).agg(F.max(ordering).alias("_last"))
        tagged = df.withColumn("_ord", ordering)
        from .stats import null_safe_join
        return (null_safe_join(tagged, last, entity)
                .filter(F.col("_ord") != F.col("_last")).drop("_ord", "_last"))
    last = df.agg(F.max(ordering).alias("_last"))
    tagged = df.withColumn("_ord", ordering)
    return tagged.join(last, tagged["_ord"] == last["_last"], "left_anti").drop("_ord")


def duplicate_count(df: DataFrame, key) -> DataFrame:
    """Rows minus distinct keys (one row)."""
    key = _as_list(key)
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg((F.sum("_n") - F.count(F.lit(1))).alias("duplicates"))
