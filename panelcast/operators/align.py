"""Calendar alignment: calendars (F15), series joins (J1-J4) and fills.

Panels are ``(entity..., date, value...)``.  Every window here is
``partitionBy(entity).orderBy(date)``; after alignment a panel holds at most
one row per (entity, calendar day), so the rows one window task sees are
bounded by the calendar length, not by the raw data volume.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FEATURE_CALENDAR_WEEKDAYS


def series_window(entity: Sequence[str] = (), time: str = "date"):
    w = Window.partitionBy(*entity) if entity else Window.partitionBy()
    return w.orderBy(time)


def _to_date(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v.isoformat()[:10]).cast("date")
    return F.lit(str(v)).cast("date")


def date_bounds(frames: Iterable[DataFrame], time: str = "date") -> tuple:
    """A3: global (min, max) of ``time`` over several tables (one small job).

    Only the two scalars reach the driver; each table contributes one partial
    aggregate row.
    """
    parts = [df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")) for df in frames]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    row = u.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    return row["lo"], row["hi"]


def calendar(spark: SparkSession, start, end, weekdays: Sequence[int] | None = FEATURE_CALENDAR_WEEKDAYS,
             time: str = "date", entities: DataFrame | None = None) -> DataFrame:
    """one row per open day in [start, end] (per entity when given).

    ``weekdays=None`` gives the daily calendar.  Without entities the days
    come from ``spark.range`` so they are spread over partitions; with
    entities each entity row expands its own days (a generator, no cross join).
    """
    s, e = _to_date(start), _to_date(end)
    if entities is None:
        if isinstance(start, Column) or isinstance(end, Column):
            days = spark.range(1).select(F.explode(F.sequence(s, e)).alias(time))
        else:
            n = (_as_date(end) - _as_date(start)).days + 1
            days = spark.range(0, max(n, 0)).select(F.date_add(s, F.col("id").cast("int")).alias(time))
    else:
        keys = entities.columns
        days = entities.select(*keys, F.explode(F.sequence(s, e)).alias(time))
    if weekdays is not None and len(set(weekdays)) < 7:
        days = days.filter(F.weekday(time).isin(list(weekdays)))
    return days


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v)[:10])


def join_series(base: DataFrame, series: Sequence[DataFrame], entity: Sequence[str] = (),
                time: str = "date", how: str = "left") -> DataFrame:
    """J1 (``how='left'``) / J2 (``how='full'``): chain equi-joins on the key.

    Each series joins on ``time`` plus whichever entity columns it carries.
    A series keyed by date only has at most one row per calendar day, so AQE
    broadcasts it from its measured size; larger sides stay sort-merge.
    USING-joins coalesce the key, as the reference's merge does.
    """
    out = base
    for s in series:
        keys = [c for c in entity if c in s.columns] + [time]
        out = out.join(s, on=keys, how=how)
    return out


def add_missing_series(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """An absent optional series becomes an all-NULL DOUBLE column."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("double") for n in missing}) if missing else df


def ffill_col(c: str, w) -> Column:
    """Last non-null value at or before the row."""
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def bfill_col(c: str, w) -> Column:
    """Backward fill (next non-null at or after the row).

    A ``currentRow..unboundedFollowing`` frame is re-evaluated per row in
    Spark (quadratic in the partition length); use ``fill(backward=True)``,
    which only needs the backward fill where the forward fill is NULL.
    """
    return F.first(c, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))


def first_non_null_col(c: str, w) -> Column:
    """First non-null value of the whole partition (evaluated once per partition)."""
    return F.first(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def fill(df: DataFrame, cols: Sequence[str], entity: Sequence[str] = (), time: str = "date",
         backward: bool = True, zero: bool = False) -> DataFrame:
    """W6 forward fill; W7 forward then backward (``backward=True``);
    W8 forward fill then 0 (``zero=True``).  One window operator for all cols.

    After a forward fill only the rows before the first non-null value are
    still NULL, and their backward fill is that first value; so W7 is
    ``coalesce(ffill, first non-null of the partition)`` - linear, where a
    literal backward-looking frame would be quadratic.
    """
    w = series_window(entity, time)
    exprs = {}
    for c in cols:
        e = ffill_col(c, w)
        if backward:
            e = F.coalesce(e, first_non_null_col(c, w))
        if zero:
            e = F.coalesce(e, F.lit(0.0))
        exprs[c] = e
    return df.withColumns(exprs)


def asof_join(left: DataFrame, right: DataFrame, value_cols: Sequence[str], entity: Sequence[str] = (),
              time: str = "date") -> DataFrame:
    """For each left row, the last right value at or before its time.

    The as-of value is resolved on the *distinct* left keys (entity, time) -
    bounded by entities x calendar days, not by the left table - by a union
    with the right side and a forward fill in key order; right rows at the
    same time sort first so they count as "at or before".  Values keep their
    type, and a NULL entity is an entity.  The result is
    then equi-joined back to the left rows, so a large left table is never
    ordered inside one window.
    """
    keys = [*entity, time]
    lk = left.select(*keys).distinct().select(*keys, *[F.lit(None).cast(right.schema[v].dataType).alias(v) for v in value_cols],
                                              F.lit(1).alias("_side"))
    rk = right.select(*keys, *value_cols, F.lit(0).alias("_side"))
    w = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy(time, "_side")
    filled = lk.unionByName(rk).withColumns({v: F.last(v, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for v in value_cols})
    resolved = filled.filter(F.col("_side") == 1).drop("_side")
    base = left.drop(*[v for v in value_cols if v in left.columns])
    out_cols = list(base.columns) + list(value_cols)
    from .stats import null_safe_join
    return null_safe_join(base, resolved, keys).select(*out_cols)


def asof_join_split(left: DataFrame, right: DataFrame, value_cols: Sequence[str], entity: Sequence[str] = (),
                    time: str = "date") -> DataFrame:
    """J4 where one entity holds most rows, or there is none: each left row
    gets the values of the last right row at or before its time.

    Both sides are sorted together by (entity, time); range partitioning
    splits an entity, and also the left rows of one time, over many tasks.  A
    partition's part of an entity takes in the last right row of the parts
    before it (a table of at most partitions + entities rows) as its own first
    row, so one window over the parts does the rest.

    Of right rows at the same time that with the largest values counts, its
    NULL values included.  Right rows without a time match nothing and left
    rows without one get NULL; a NULL entity is an entity.  Rows, also
    repeated ones, and columns of the left side stay, except that columns
    named like a value are replaced.
    """
    entity, values = list(entity), list(value_cols)
    rest = [c for c in left.columns if c not in {*entity, time, *values}]
    key = [f"_e{i}" for i in range(len(entity))]
    named = [F.col(f"`{e}`").alias(k) for e, k in zip(entity, key, strict=True)]
    vals = F.struct(*[F.col(f"`{v}`").alias(f"_v{i}") for i, v in enumerate(values)])
    row = F.struct(F.lit(0).alias("_x"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest)])
    at = F.col(f"`{time}`").alias("_t")
    r = right.where(F.col(f"`{time}`").isNotNull()).select(*named, at, F.lit(0).alias("_side"), vals.alias("_vals"))
    lf = left.select(*named, at, F.lit(1).alias("_side"), row.alias("_row"))
    lf = lf.withColumn("_tie", F.xxhash64("_row"))
    order = ["_t", "_side", "_vals", "_tie"]
    srt = r.unionByName(lf, allowMissingColumns=True).orderBy(*key, *order).checkpoint(eager=True)
    srt = srt.withColumn("_pid", F.spark_partition_id())
    parts = srt.groupBy("_pid", *key).agg(F.max(F.when(F.col("_side") == 0, F.struct("_t", "_vals"))).alias("_last"))
    w = (Window.partitionBy(*key) if key else Window.partitionBy()).orderBy("_pid")
    before = F.last("_last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    carried = parts.select("_pid", *key, F.lit(-1).alias("_side"), before["_vals"].alias("_vals"))
    every = srt.unionByName(carried, allowMissingColumns=True)
    part = Window.partitionBy("_pid", *key).orderBy(F.col("_side") >= 0, *order)
    found = F.last("_vals", ignorenulls=True).over(part.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = every.withColumn("_found", found).where("_side = 1")
    place = {**{e: F.col(k) for e, k in zip(entity, key, strict=True)}, time: F.col("_t"),
             **{c: F.col("_row")[f"_c{i}"] for i, c in enumerate(rest)}}
    kept = [c for c in left.columns if c not in values]
    return out.select(*[place[c].alias(c) for c in kept],
                      *[F.col("_found")[f"_v{i}"].alias(v) for i, v in enumerate(values)])


def ffill_distributed(df: DataFrame, cols: Sequence[str], entity: Sequence[str] = (), order: Sequence[str] = ("date",),
                      backward: bool = False) -> DataFrame:
    """W6 for series too long for one task (one entity holding most rows, or
    no entity at all): a two-phase forward fill.

    1. sort by (entity, order) - range partitioning splits a long series
       over many tasks - and checkpoint the layout;
    2. fill inside each partition (``mapInPandas``, vectorised, carrying the
       last value between Arrow batches; no second shuffle);
    3. per (partition, entity) the last non-null value; a running "last
       non-null" over that small table gives the value each partition
       carries in from the partitions before it;
    4. rows still NULL after step 2 take the carried value (a join on
       partition and entity with a table of at most partitions + entities
       rows).
    ``order`` must be a total order within the entity.  Float NaN inputs are
    treated as NULL.  ``backward=True`` gives W7: rows still NULL after the
    forward fill (an entity's leading rows) take the entity's first non-null
    value, one ``min_by`` aggregate per entity joined back.
    """
    import pandas as pd

    cols, entity, order = list(cols), list(entity), list(order)
    srt = df.orderBy(*entity, *order).checkpoint(eager=True).withColumn("_pid", F.spark_partition_id())
    schema = srt.schema

    def local(batches):
        last: dict = {c: {} for c in cols}
        for pdf in batches:
            keys = pd.Series(list(zip(*[pdf[e] for e in entity])), index=pdf.index) if entity else \
                pd.Series([()] * len(pdf), index=pdf.index)
            for c in cols:
                filled = pdf.groupby(keys, sort=False)[c].ffill() if entity else pdf[c].ffill()
                miss = filled.isna()
                if miss.any():
                    filled = filled.where(~miss, keys.map(last[c]))
                pdf[c] = filled
                last[c].update(pdf.assign(_k=keys).groupby("_k", sort=False)[c].last().dropna().to_dict())
            yield pdf

    filled = srt.mapInPandas(local, schema)
    ordering = F.struct(*[F.col(o) for o in order])
    seg = srt.groupBy("_pid", *entity).agg(*[
        F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), ordering)).alias(f"_last_{c}")
        for c in cols])
    before = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    carry = seg.select("_pid", *entity, *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}")
                                          for c in cols])
    carry = carry if entity else F.broadcast(carry)       # no entity: one row per partition
    from .stats import null_safe_join
    out = null_safe_join(filled, carry, ["_pid", *entity])
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_carry_{c}")) for c in cols})
    if backward:
        firsts = srt.groupBy(*entity).agg(*[
            F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), ordering)).alias(f"_first_{c}")
            for c in cols])
        if entity:
            out = null_safe_join(out, firsts, entity)
        else:   # one row: a proven size bound
            out = out.withColumn("_one", F.lit(0)).join(F.broadcast(firsts.withColumn("_one", F.lit(0))), "_one")
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_first_{c}")) for c in cols})
    return out.select(*df.columns)
