"""Streaming ingest (T2, T4, T5) and the runner used by the registered
queries.

* T2 ``typed_ticks``: parse the JSON payload with an explicit schema; rows
  missing a required variable go to a quarantine output instead of failing.
* T4 ``merge_on_read_sink`` / ``read_merged``: each micro-batch is written
  under ``epoch=<batch id>`` (overwrite, so a replayed batch is idempotent);
  readers keep the last delivery per key.  ``dropDuplicatesWithinWatermark``
  keeps the *first* copy, which is not the reference's keep-last.
  ``merged_sink`` writes the same deliveries into a ``MergedTable``, whose
  reads and compactions grow with the deltas, not with the history.
* T5 ``history_sink``: one monitoring row per micro-batch; epochs beyond the
  newest ``keep`` are dropped from the store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe
from ..sources.merge import MergedTable
from ..sources.versions import retain_epochs


def typed_ticks(raw: DataFrame, payload: str, schema: str, required: Sequence[str],
                keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined rows)."""
    parsed = raw.select(*keep, F.from_json(F.col(payload), schema).alias("_p"), F.col(payload).alias("_raw"))
    flat = parsed.select(*keep, "_p.*", "_raw")
    ok = F.lit(True)
    for r in required:
        ok = ok & F.col(r).isNotNull()
    return flat.filter(ok).drop("_raw"), flat.filter(~ok).select(*keep, "_raw")


def merge_on_read_sink(path: str):
    """T4 foreachBatch writer: idempotent per epoch."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("_epoch", F.lit(epoch_id)).write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
    return write


def read_merged(spark: SparkSession, path: str, key, order: Sequence[str]) -> DataFrame:
    """T4 reader: union of all epochs, keep the last delivery per key by
    (epoch, order...)."""
    allb = spark.read.option("basePath", path).parquet(f"{path}/epoch=*").drop("epoch")
    return dedupe(allb, key, ["_epoch", *order], keep="last").drop("_epoch")


def merged_sink(table: MergedTable, compact_every: int = 10):
    """T4 foreachBatch writer into a keyed table; deltas are merged into their
    buckets every ``compact_every`` epochs."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        table.write(batch, epoch_id)
        if len(table.pending()) >= compact_every:
            table.compact()
    return write


def history_sink(path: str, value: str, keep: int = 100):
    """T5 foreachBatch writer: one report row per micro-batch, in a folder of
    its epoch, so a replayed epoch replaces its row; only the newest ``keep``
    epochs stay stored."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        rep = batch.agg(F.count(F.lit(1)).alias("rows"), F.avg(value).alias("mean_value"),
                        F.max("ts").alias("max_ts")).withColumn("batch_id", F.lit(epoch_id))
        rep.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
        retain_epochs(batch.sparkSession, path, keep)
    return write


def run_available(stream_df: DataFrame, sink: str | None = None, checkpoint: str = "", fmt: str = "parquet",
                  foreach_batch=None, output_mode: str = "append", timeout_s: int | None = None,
                  state_partitions: int | None = None) -> None:
    """Run a streaming query over everything available, then stop.

    ``state_partitions`` fixes the number of state-store partitions of a
    stateful query (it is frozen in the checkpoint at the first start);
    when given, it is set only while the query starts.
    """
    spark = stream_df.sparkSession
    w = stream_df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(availableNow=True)
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        if foreach_batch is not None:
            q = w.foreachBatch(foreach_batch).start()
        else:
            q = w.format(fmt).option("path", sink).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming query did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
