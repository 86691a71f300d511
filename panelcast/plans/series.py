"""Series loaders over the given tables.

Each loader returns a ``(entity..., date, value)`` DataFrame with one row per
key: the raw table is reduced by a grouped aggregate (partial aggregation
before the shuffle), so the series is bounded by the number of days, not by
the table size.  Only the columns a loader needs reach the parquet scan.

| reference series | stand-in                                                  |
|------------------|-----------------------------------------------------------|
| gold (daily)     | orders: avg(o_totalprice) by day [, o_orderpriority]      |
| set (daily)      | lineitem: avg(l_extendedprice) by ship day                |
| fx (monthly)     | lineitem: avg(l_discount) by ``yyyy-MM`` ship period      |
| cpi (monthly)    | lineitem: avg(l_tax) by ship period                       |
| oil (monthly)    | lineitem x part: avg(l_extendedprice) by period and brand, |
|                  | then the mean over brands per date (A1)                   |
| btc (daily, opt) | lineitem: sum(l_quantity) by ship day                     |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def gold_series(spark: SparkSession, sf_dir: str, by_priority: bool = True) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    keys = (["o_orderpriority"] if by_priority else []) + [F.to_date("o_orderdate").alias("date")]
    return o.groupBy(*keys).agg(F.avg("o_totalprice").alias("gold"))


def lineitem_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of lineitem -> per ship day sums and counts of the measures
    behind set, fx, cpi and btc (one row per day).  Monthly averages are
    rolled up from these exactly (sum of sums / sum of counts)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_extendedprice").alias("s_ext"), F.count("l_extendedprice").alias("n_ext"),
        F.sum("l_discount").alias("s_disc"), F.count("l_discount").alias("n_disc"),
        F.sum("l_tax").alias("s_tax"), F.count("l_tax").alias("n_tax"),
        F.sum("l_quantity").alias("btc"))


def set_series(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    d = daily if daily is not None else lineitem_daily(spark, sf_dir)
    return d.select("date", (F.col("s_ext") / F.col("n_ext")).alias("set"))


def _period(c: str):
    return F.date_format(c, "yyyy-MM")


def _monthly(d: DataFrame, s: str, n: str, name: str) -> DataFrame:
    by_period = d.groupBy(_period("date").alias("period")).agg((F.sum(s) / F.sum(n)).alias(name))
    return by_period.select(month_start("period").alias("date"), name)


def fx_series(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    d = daily if daily is not None else lineitem_daily(spark, sf_dir)
    return _monthly(d, "s_disc", "n_disc", "fx")


def cpi_series(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    d = daily if daily is not None else lineitem_daily(spark, sf_dir)
    return _monthly(d, "s_tax", "n_tax", "cpi")


def oil_brand_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-series monthly table ``(date, series, value)``.

    lineitem is pre-aggregated to (period, partkey) sums and counts before
    the join, so the join input shrinks and a hot part key collapses to one
    row per period before any shuffle on the part key.
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    pre = (li.groupBy(_period("l_shipdate").alias("period"), F.col("l_partkey"))
           .agg(F.sum("l_extendedprice").alias("s"), F.count("l_extendedprice").alias("n")))
    joined = pre.join(part, pre["l_partkey"] == part["p_partkey"], "inner")
    by_brand = (joined.groupBy("period", F.col("p_brand").alias("series"))
                .agg((F.sum("s") / F.sum("n")).alias("value")))
    return by_brand.select(month_start("period").alias("date"), "series", "value")


def oil_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: mean over the series of one date."""
    return oil_brand_series(spark, sf_dir).groupBy("date").agg(F.avg("value").alias("oil"))


def btc_series(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    d = daily if daily is not None else lineitem_daily(spark, sf_dir)
    return d.select("date", "btc")


def all_series(spark: SparkSession, sf_dir: str, with_btc: bool = True, by_priority: bool = True,
               materialize: bool = True) -> list[DataFrame]:
    """gold, fx, cpi, oil, set [, btc] from three scans (orders, lineitem,
    lineitem x part).  With ``materialize`` the small per-day results are
    cached; the bounds job of the feature build fills the cache in its one
    pass.  lineitem is read by two loaders (per day, and per period and part):
    one aggregate for both would keep nearly every row.  A lost cache block is
    recomputed from lineage, so executor loss only costs time."""
    gold = gold_series(spark, sf_dir, by_priority)
    daily = lineitem_daily(spark, sf_dir)
    oil = oil_series(spark, sf_dir)
    if materialize:
        gold, daily, oil = gold.cache(), daily.cache(), oil.cache()
    out = [gold, fx_series(spark, sf_dir, daily), cpi_series(spark, sf_dir, daily), oil,
           set_series(spark, sf_dir, daily)]
    if with_btc:
        out.append(btc_series(spark, sf_dir, daily))
    return out
