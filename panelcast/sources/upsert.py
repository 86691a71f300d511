"""Keyed upsert (S10), append (S11), batch assignment (S13), bounded
history (S16) and top-n read-back (S17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe
from ..operators.ranks import global_index


def upsert(old: DataFrame, new: DataFrame, key, seq, keep: str = "last") -> DataFrame:
    """Union by name (missing columns NULL), then one row per key -
    the latest by ``seq`` (new rows carry larger ``seq``)."""
    u = old.unionByName(new, allowMissingColumns=True)
    return dedupe(u, key, seq, keep=keep)


def upsert_tagged(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """S10 when no sequence column exists: new rows win over old ones."""
    o = old.withColumn("_batch", F.lit(0))
    n = new.withColumn("_batch", F.lit(1))
    return upsert(o, n, key, "_batch").drop("_batch")


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append without dedupe."""
    df.write.mode("append").format(fmt).save(path)


def assign_chunks(df: DataFrame, order, size: int = 500, col: str = "chunk_id") -> DataFrame:
    """Consecutive batches of ``size`` rows in ``order``.

    The global position comes from ``global_index`` (sorted layout plus
    per-partition offsets), not from an unpartitioned window, so no task
    holds more than one sort partition.
    """
    idx = global_index(df, order, col="_pos")
    return idx.withColumn(col, F.floor(F.col("_pos") / size).cast("long")).drop("_pos")


def keep_newest(history: DataFrame, order: str, n: int = 100) -> DataFrame:
    """Keep the newest ``n`` rows (a top-k, no full sort)."""
    return history.orderBy(F.col(order).desc()).limit(n)


def read_back(df: DataFrame, order: str = "date", n: int = 3, columns: Sequence[str] | None = None) -> DataFrame:
    """Top-n rows by ``order`` descending."""
    out = df.select(*columns) if columns else df
    return out.orderBy(F.col(order).desc()).limit(n)
