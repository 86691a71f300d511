"""Registered queries: Structured Streaming paths.

The stream source is the ``events`` table re-delivered by Spark as files in
weekly chunks (appended in time order, each user's rows of a chunk in one
file, hash-partitioned by user), read by the file stream source a few files
per micro-batch and run with ``availableNow``.  Checkpoints and sinks live
under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming.features import stream_features
from ..streaming.ingest import history_sink, merge_on_read_sink, read_merged, run_available, typed_ticks
from .registry import register
from .series import read_table
from .sqlgen import R

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _deliver(spark, sf_dir, corrections: bool = False) -> tuple[str, int]:
    """Write events as weekly chunks into one folder (append, in order);
    returns the folder and the number of files per chunk."""
    ev = read_table(spark, sf_dir, "events")
    b = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    weeks = (b["hi"] - b["lo"]).days // 7 + 1
    path = scratch_path(spark, f"stream-src-{uuid.uuid4().hex}")
    chunk = F.floor(F.datediff(F.col("ts"), F.lit(b["lo"]).cast("timestamp_ntz")) / 7)
    n_files = files_per_chunk(b["n"], weeks)
    for c in range(weeks):
        part = ev.filter(chunk == c).repartition(n_files, "user_id")
        part.write.mode("append").parquet(path)
    if corrections:
        fix = ev.filter(F.dayofmonth("ts").isin(5, 6)).withColumn("value", F.col("value") * 2)
        fix.repartition(n_files, "user_id").write.mode("append").parquet(path)
    return path, n_files


def files_per_chunk(rows: int, chunks: int, rows_per_file: int = 1_000_000) -> int:
    """Files per weekly chunk: about a million rows each, at least 2."""
    return int(max(2, -(-rows // max(1, chunks) // rows_per_file)))


def _source(spark, delivered: tuple[str, int]):
    """File stream over the delivered chunks, about one chunk per micro-batch
    (a user's rows of one chunk sit in one file, so per-user order holds even
    when a micro-batch straddles two chunks)."""
    path, files = delivered
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(path)


def state_partitions(spark, delivered: tuple[str, int]) -> int:
    """State-store partitions for the per-user state: at least one per core
    (the per-user step runs in Python workers), two per file of a micro-batch,
    at most four per core; the state grows with the number of users, not rows."""
    cores = spark.sparkContext.defaultParallelism
    return int(min(4 * cores, max(cores, 2 * delivered[1])))


@register("t3_stream_features", ("T1", "T3", "W1", "W3", "W4"), f"""
WITH w AS (SELECT user_id, ts, value,
  lag(value, 1) OVER (PARTITION BY user_id ORDER BY ts) AS value_lag1,
  lag(value, 3) OVER (PARTITION BY user_id ORDER BY ts) AS value_lag3,
  CASE WHEN count(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 3
       THEN avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS roll,
  value / NULLIF(lag(value) OVER (PARTITION BY user_id ORDER BY ts), 0) - 1 AS pc FROM events)
SELECT user_id, ts, {R('value')} AS value, {R('value_lag1')} AS value_lag1, {R('value_lag3')} AS value_lag3,
  {R('roll')} AS value_roll7_mean, {R('pc', 6)} AS value_pct_change, false AS late FROM w""")
def t3_stream_features(spark, sf_dir):
    """Per-user lag / rolling / change features computed on the stream from
    a 14-row state per user; equals the batch window result."""
    src = _deliver(spark, sf_dir)
    out = scratch_path(spark, f"stream-t3-{uuid.uuid4().hex}")
    feats = stream_features(_source(spark, src), "user_id", "ts", "value")
    run_available(feats, f"{out}/data", f"{out}/_checkpoint", state_partitions=state_partitions(spark, src))
    res = spark.read.parquet(f"{out}/data")
    nudge = F.lit(1.000000000001)
    return res.select("user_id", "ts", *[F.round(F.col(c) * nudge, 4).alias(c) for c in
                                         ("value", "value_lag1", "value_lag3", "value_roll7_mean")],
                      F.round(F.col("value_pct_change") * nudge, 6).alias("value_pct_change"), "late")


@register("t2_typed_ticks", ("T2", "S6"), f"""
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, {R('value')} AS value
FROM events WHERE event_type <> 'error'""")
def t2_typed_ticks(spark, sf_dir):
    """Payloads parsed on the stream; error events carry a truncated payload
    and are quarantined instead of failing the query."""
    src = _deliver(spark, sf_dir)
    out = scratch_path(spark, f"stream-t2-{uuid.uuid4().hex}")
    s = _source(spark, src)
    payload = F.when(F.col("event_type") == "error", F.expr("substring(props, 1, 4)")).otherwise(F.col("props"))
    raw = s.select("event_id", "user_id", "value", payload.alias("payload"))

    def write(batch, epoch_id):
        good, bad = typed_ticks(batch, "payload", "k int", ["k"], keep=["event_id", "user_id", "value"])
        good.write.mode("overwrite").parquet(f"{out}/typed/epoch={epoch_id}")
        bad.write.mode("overwrite").parquet(f"{out}/quarantine/epoch={epoch_id}")

    run_available(raw, checkpoint=f"{out}/_checkpoint", foreach_batch=write)
    res = spark.read.parquet(f"{out}/typed").drop("epoch")
    return res.select("event_id", "user_id", "k", F.round(F.col("value") * F.lit(1.000000000001), 4).alias("value"))


@register("t4_stream_upsert", ("T4", "S10", "W9"), f"""
SELECT event_id, user_id, CASE WHEN day(ts) IN (5, 6) THEN {R('value * 2')} ELSE {R('value')} END AS value
FROM events""")
def t4_stream_upsert(spark, sf_dir):
    """Deliveries with late corrected duplicates (days 5-6 re-sent with new
    values after the rest): idempotent per-epoch writes, keep-last on read."""
    src = _deliver(spark, sf_dir, corrections=True)
    out = scratch_path(spark, f"stream-t4-{uuid.uuid4().hex}")
    s = _source(spark, src).select("event_id", "user_id", "value", "ts")
    run_available(s, checkpoint=f"{out}/_checkpoint", foreach_batch=merge_on_read_sink(f"{out}/table"))
    merged = read_merged(spark, f"{out}/table", "event_id", ["ts"])
    return merged.select("event_id", "user_id", F.round(F.col("value") * F.lit(1.000000000001), 4).alias("value"))


@register("t5_stream_monitoring", ("T5", "S16"))
def t5_stream_monitoring(spark, sf_dir):
    """One monitoring row per micro-batch appended to a history of which the
    newest 100 entries stay stored; the whole store is read."""
    src = _deliver(spark, sf_dir)
    out = scratch_path(spark, f"stream-t5-{uuid.uuid4().hex}")
    run_available(_source(spark, src), checkpoint=f"{out}/_checkpoint",
                  foreach_batch=history_sink(f"{out}/history", "value"))
    return spark.read.parquet(f"{out}/history").drop("epoch")
