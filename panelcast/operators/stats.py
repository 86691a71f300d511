"""Aggregations over series and measurement tables.

Conventions: ``entity`` columns group the result; "tail" operators work on
the last ``n`` rows of each entity by ``time``; sample statistics are
``stddev_samp``/``var_samp`` (pandas ``.std()/.var()``), population ones are
named so (numpy ``np.std``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .align import series_window


def _w(entity: Sequence[str]):
    return Window.partitionBy(*entity) if entity else Window.partitionBy()


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on columns of both sides in which NULL equals NULL; the left
    side's keys are kept."""
    own = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r._key_{k}")) for k in keys]
    return left.alias("_l").join(own.alias("_r"), on, how).drop(*[f"_key_{k}" for k in keys])


def attach_stats(df: DataFrame, stats: DataFrame, entity: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Join per-entity statistics back onto the rows.

    With entity keys this is a null-safe equi-join, so a NULL entity is an
    entity (AQE broadcasts the stats side when it is small).  Without keys ``stats`` is a global aggregate - exactly one
    row, a proven size bound - and is broadcast on a constant key.
    """
    if entity:
        return null_safe_join(df, stats, entity, how)
    one = F.broadcast(stats.withColumn("_one", F.lit(0)))
    return df.withColumn("_one", F.lit(0)).join(one, "_one", how).drop("_one")


# --------------------------------------------------------------------- tails

def tail_rows(df: DataFrame, n: int, entity: Sequence[str] = (), time: str = "date",
              index_col: str | None = None) -> DataFrame:
    """The last ``n`` rows of each entity by ``time``.

    ``row_number() <= n`` over a descending window is planned as a
    WindowGroupLimit, which keeps only ``n`` rows per entity in each task
    before the shuffle, so a hot entity does not ship all its rows.
    ``index_col`` adds the 0-based position inside the tail (oldest = 0).
    """
    wd = _w(entity).orderBy(F.col(time).desc())
    out = df.withColumn("_rn", F.row_number().over(wd)).filter(F.col("_rn") <= n)
    if index_col:
        cnt = F.count(F.lit(1)).over(_w(entity))
        out = out.withColumn(index_col, cnt - F.col("_rn"))
    return out.drop("_rn")


def trailing_metrics(df: DataFrame, value: str, n: int = 30, entity: Sequence[str] = (),
                     time: str = "date") -> DataFrame:
    """A5: current, min, max, avg, sample std, change, change %, volatility
    (std / mean * 100) over the last ``n`` rows of each entity."""
    t = tail_rows(df, n, entity, time)
    cur = F.max_by(value, time)
    first = F.min_by(value, time)
    std = F.stddev_samp(value)
    mean = F.avg(value)
    return t.groupBy(*entity).agg(
        cur.alias("current"), F.min(value).alias("min"), F.max(value).alias("max"),
        mean.alias("avg"), std.alias("std"), (cur - first).alias("change"),
        F.try_divide(cur - first, first).alias("_chg")
    ).withColumn("change_pct", F.col("_chg") * 100).drop("_chg").withColumn(
        "volatility", F.try_divide(F.col("std"), F.col("avg")) * 100)


def first_last_diff(df: DataFrame, value: str, n: int = 30, entity: Sequence[str] = (),
                    time: str = "date") -> DataFrame:
    """Last minus first value of the trailing ``n`` rows."""
    t = tail_rows(df, n, entity, time)
    return t.groupBy(*entity).agg((F.max_by(value, time) - F.min_by(value, time)).alias("diff"))


def tail_slope(df: DataFrame, value: str, n: int = 7, entity: Sequence[str] = (),
               time: str = "date") -> DataFrame:
    """Least-squares slope of the last ``n`` values over their index."""
    t = tail_rows(df, n, entity, time, index_col="_x")
    return t.groupBy(*entity).agg(F.regr_slope(F.col(value), F.col("_x").cast("double")).alias("slope"))


def tail_mean_pct_change(df: DataFrame, value: str, n: int = 7, entity: Sequence[str] = (),
                         time: str = "date") -> DataFrame:
    """Mean of the row-to-row change inside the tail, in percent (the
    first tail row has no predecessor inside the tail)."""
    t = tail_rows(df, n, entity, time)
    w = series_window(entity, time)
    pc = F.try_divide(F.col(value), F.lag(value).over(w)) - 1
    return t.withColumn("_pc", pc).groupBy(*entity).agg((F.avg("_pc") * 100).alias("avg_change_pct"))


def tail_variance(df: DataFrame, value: str, n: int = 10, entity: Sequence[str] = (),
                  time: str = "date") -> DataFrame:
    """Sample variance of the last ``n`` values."""
    t = tail_rows(df, n, entity, time)
    return t.groupBy(*entity).agg(F.var_samp(value).alias("variance"))


def tail_correlations(df: DataFrame, target: str, cols: Sequence[str], n: int = 180,
                      entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """A6 + K7: Pearson correlation of each column with ``target`` over the
    last ``n`` rows, as (entity, variable, corr) rows ranked descending."""
    t = tail_rows(df, n, entity, time)
    wide = t.groupBy(*entity).agg(*[F.corr(target, c).alias(c) for c in cols])
    long = wide.unpivot(list(entity), list(cols), "variable", "corr") if entity else \
        wide.unpivot([], list(cols), "variable", "corr")
    rank = F.row_number().over(_w(entity).orderBy(F.col("corr").desc_nulls_last(), "variable"))
    return long.withColumn("rank", rank)


# ------------------------------------------------------------ descriptive

def descriptive_stats(df: DataFrame, value: str, entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """A4: count, min, max, mean, median, sample std, distinct count and the
    mean of the first difference (diff by ``time`` within the entity)."""
    w = series_window(entity, time)
    d = df.withColumn("_diff", F.col(value) - F.lag(value).over(w))
    base = d.groupBy(*entity).agg(
        F.count(value).alias("count"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.countDistinct(value).alias("unique"), F.avg("_diff").alias("mean_daily_diff"))
    # The median by distributed ranks: no task holds a whole group.
    return attach_stats(base, exact_percentiles(df, value, (0.5,), entity, ("median",)), entity)


def range_report(df: DataFrame, time: str = "date", value: str | None = None,
                 entity: Sequence[str] = ()) -> DataFrame:
    """Row count, first and last date (and the latest value)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(time).alias("start"), F.max(time).alias("end")]
    if value:
        aggs.append(F.max_by(value, time).alias("latest"))
    return df.groupBy(*entity).agg(*aggs)


def gap_count(df: DataFrame, days: int = 7, entity: Sequence[str] = (), time: str = "date") -> DataFrame:
    """Number of steps with more than ``days`` between consecutive dates.

    Repeated dates only add gaps of 0, so the window runs over the distinct
    (entity, date) pairs - at most one row per calendar day per entity, even
    for an entity that holds most of the rows.
    """
    d = df.select(*entity, F.to_date(time).alias(time)).distinct()
    w = series_window(entity, time)
    gap = F.datediff(F.col(time), F.lag(time).over(w))
    return d.withColumn("_gap", gap).groupBy(*entity).agg(F.count_if(F.col("_gap") > days).alias("gaps"))


def null_report(df: DataFrame, cols: Sequence[str] | None = None, top: int = 10) -> DataFrame:
    """A10: per column NULL count and percent, non-zero only, top ``top``.

    One aggregate pass over the table, then an unpivot of the single row.
    """
    cols = list(cols) if cols is not None else df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column", "nulls")
    long = long.withColumn("null_pct", F.col("nulls") / F.col("_n") * 100).drop("_n")
    return long.filter(F.col("nulls") > 0).orderBy(F.col("nulls").desc(), "column").limit(top)


# ----------------------------------------------------------- percentiles

def exact_percentiles(df: DataFrame, value: str, ps: Sequence[float], group: Sequence[str] = (),
                      names: Sequence[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (numpy / DuckDB
    ``quantile_cont``) that never gather a group in one task.

    1. sort ``(group, value)`` globally (range partitioning splits a hot
       group over many tasks) and checkpoint the sorted layout;
    2. per (partition, group) count rows and note the first row id - a
       table of at most partitions + groups rows;
    3. a running sum over that small table gives each segment's offset, so
       every row gets its rank inside its group;
    4. keep only the rows at the needed ranks (two per percentile) and
       interpolate.
    """
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in ps]
    group = list(group)
    v = df.select(*group, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    srt = v.orderBy(*group, "_v").checkpoint(eager=True)
    idx = srt.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    seg = idx.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_first"))
    gw = _w(group)
    seg = seg.withColumn("_before", F.coalesce(
        F.sum("_c").over(gw.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("_n", F.sum("_c").over(gw))
    ranked = _join_null_safe(idx, seg, ["_pid", *group]).withColumn(
        "_r", F.col("_before") + F.col("_mid") - F.col("_first"))
    conds = []
    for p in ps:
        h = (F.col("_n") - 1) * F.lit(float(p))
        conds += [F.col("_r") == F.floor(h), F.col("_r") == F.ceil(h)]
    keep = conds[0]
    for c in conds[1:]:
        keep = keep | c
    picked = ranked.filter(keep)
    aggs = []
    for p, name in zip(ps, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo = F.max(F.when(F.col("_r") == F.floor(h), F.col("_v")))
        hi = F.max(F.when(F.col("_r") == F.ceil(h), F.col("_v")))
        frac = F.max(h - F.floor(h))
        aggs.append((lo + (hi - lo) * frac).alias(name))
    return picked.groupBy(*group).agg(*aggs)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join on ``keys`` where NULL keys match (a NULL group is a group)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def approx_percentiles(df: DataFrame, value: str, ps: Sequence[float], group: Sequence[str] = (),
                       names: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """Percentiles from a mergeable sketch (``percentile_approx``): one
    partial-aggregated pass, bounded memory per group, rank error about
    1/``accuracy`` of the group size.  The at-scale alternative to
    ``exact_percentiles`` when an exact order statistic is not required."""
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in ps]
    arr = F.percentile_approx(F.col(value).cast("double"), list(ps), accuracy).alias("_p")
    out = df.groupBy(*group).agg(arr)
    return out.select(*group, *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])


def _percentiles(df, value, ps, group, names=None, exact=True):
    return (exact_percentiles(df, value, ps, group, names) if exact
            else approx_percentiles(df, value, ps, group, names))


def measurement_summary(df: DataFrame, value: str, group: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Mean, population std, p50/p95/p99 and count per group
    (``exact=False``: sketch percentiles, no sort)."""
    pct = _percentiles(df, value, (0.5, 0.95, 0.99), group, exact=exact)
    base = df.groupBy(*group).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                                  F.count(value).alias("n"))
    return attach_stats(base, pct, group)


# ------------------------------------------------------ regression metrics

def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       entity: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R2, MAPE % and accuracy = 100 - MAPE in one pass.

    R2 = 1 - SSE / (n * var_pop(y)); defined as 1 when both are 0 (constant
    series predicted exactly).  MAPE divides by the signed actual inside abs.
    """
    e = F.col(actual) - F.col(predicted)
    d = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    out = d.groupBy(*entity).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sum(e * e).alias("_sse"),
        (F.var_pop(actual) * F.count(F.lit(1))).alias("_sst"),
        (F.avg(F.abs(F.try_divide(e, F.col(actual)))) * 100).alias("mape"))
    r2 = (F.when((F.col("_sst") == 0) & (F.col("_sse") == 0), F.lit(1.0))
          .otherwise(1 - F.try_divide(F.col("_sse"), F.col("_sst"))))
    return (out.withColumn("rmse", F.sqrt("mse")).withColumn("r2", r2)
            .withColumn("accuracy", 100 - F.col("mape")).drop("_sse", "_sst"))


def balance_index(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                  entity: Sequence[str] = ()) -> DataFrame:
    """(over-predictions - under-predictions) / rows."""
    return df.groupBy(*entity).agg(
        ((F.count_if(F.col(predicted) > F.col(actual)) - F.count_if(F.col(predicted) < F.col(actual)))
         / F.count(F.lit(1))).alias("balance_index"))


# --------------------------------------------------------------- outliers

def outlier_flags(df: DataFrame, value: str, entity: Sequence[str] = (), method: str = "iqr",
                  threshold: float = 3.0, min_support: int = 10, exact: bool = True) -> DataFrame:
    """A16 (IQR) / A17 (z-score, sample std) outlier flag with the A18 guard:
    groups with ``min_support`` or fewer non-null values are not tested.

    Group statistics are one aggregate per entity, joined back on the entity
    (AQE broadcasts that side when it is small).  NULL values are never
    outliers.
    """
    if method == "iqr":
        q = _percentiles(df, value, (0.25, 0.75), entity, names=("_q1", "_q3"), exact=exact)
        cnt = df.groupBy(*entity).agg(F.count(value).alias("_cnt"))
        stats = attach_stats(cnt, q, entity)
        iqr = F.col("_q3") - F.col("_q1")
        out_expr = (F.col(value) < F.col("_q1") - threshold * iqr) | (F.col(value) > F.col("_q3") + threshold * iqr)
        drop = ["_q1", "_q3", "_cnt"]
    else:
        stats = df.groupBy(*entity).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"),
                                        F.count(value).alias("_cnt"))
        out_expr = F.abs(F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd"))) > threshold
        drop = ["_mu", "_sd", "_cnt"]
    joined = attach_stats(df, stats, entity)
    flag = F.coalesce((F.col("_cnt") > min_support) & F.col(value).isNotNull() & out_expr, F.lit(False))
    return joined.withColumn("is_outlier", flag).drop(*drop)


# --------------------------------------------------------------- shares

def share_of_total(df: DataFrame, value: str, out: str = "share_pct", group: Sequence[str] = ()) -> DataFrame:
    """Value / total * 100 (within ``group``).  Meant for aggregated
    tables (one row per feature / category), whose size is bounded."""
    return df.withColumn(out, F.col(value) / F.sum(value).over(_w(group)) * 100)


def prefix_group_sums(df: DataFrame, name_col: str, value: str, prefixes: Sequence[str]) -> DataFrame:
    """Sum of ``value`` per first matching name prefix (in order);
    names without a match and empty groups are dropped; sorted descending."""
    pattern = "^(" + "|".join(prefixes) + ")"
    g = F.regexp_extract(F.col(name_col), pattern, 1)
    return (df.withColumn("group", g).filter(F.col("group") != "")
            .groupBy("group").agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("features"))
            .orderBy(F.col(value).desc(), "group"))


def top_share(df: DataFrame, value: str, n: int = 10, order: str | None = None) -> DataFrame:
    """Sum of ``value`` over the top ``n`` rows by ``order`` (desc)."""
    order = order or value
    top = df.orderBy(F.col(order).desc()).limit(n)
    return top.agg(F.sum(value).alias(f"top{n}_{value}"))


def uptime_pct(df: DataFrame, ts: str, healthy: Column, as_of, hours: int = 24) -> DataFrame:
    """Healthy checks / all checks in the last ``hours`` before
    ``as_of`` in percent; 100 when there is no check."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(hours)} HOURS")
    w = df.filter((F.col(ts) > start) & (F.col(ts) <= F.lit(as_of).cast("timestamp_ntz")))
    return w.agg(F.coalesce(F.avg(F.when(healthy, 1.0).otherwise(0.0)) * 100, F.lit(100.0)).alias("uptime_pct"),
                 F.count(F.lit(1)).alias("checks"))


def seeded_hash(key, seed: int) -> Column:
    """K8: a seeded multiplicative hash of an integer key in [0, 2^32) -
    deterministic and partition-independent, so ``orderBy(hash).limit(n)``
    is a reproducible sample of n rows (plain integer arithmetic, no
    overflow for any BIGINT key)."""
    m = 4294967296
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k, F.lit(m)) * F.lit(40503) + F.lit(seed * 69069), F.lit(m))
