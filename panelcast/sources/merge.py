"""Keyed tables that grow by deltas.

Rows are dealt to hash buckets of their key.  A delivery is written as a delta
of its epoch, one folder for each bucket it touches; a replayed epoch replaces
itself.  Readers take the base and let the deltas since its last compaction win;
compaction rewrites the buckets that deltas touch and no others, and publishes
them with the epoch that they reach in one commit, so that readers leave those
deltas out from then on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.dedupe import dedupe
from ..operators.ranks import global_index
from .versions import VersionedStore, delete, exists, folders


class MergedTable:
    """``schema``: columns of the table; ``key``: columns that name a row;
    ``order``: columns that decide between rows of one epoch and key (a later
    epoch always wins).  ``buckets`` is fixed when the table is first written:
    some 100 MB of base in each is a good size."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], order: Sequence[str] = (),
                 buckets: int = 64):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order, self.buckets = list(key), list(order), buckets
        self.base = VersionedStore(spark, f"{self.path}/base")

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def write(self, batch: DataFrame, epoch: int) -> None:
        """One delivery; also a ``foreachBatch`` function."""
        d = batch.select(*self.schema.names).withColumn("_bucket", self._bucket())
        # One file for each bucket of the delta, or more where AQE splits a large one.
        d.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/delta/_epoch={epoch}")

    def compacted(self) -> int:
        """The last epoch that the base holds; -1 before the first compaction."""
        return int(self.base.info("table").get("epoch", -1))

    def pending(self) -> list[int]:
        """Epochs beyond the base; a delta counts once its write has ended."""
        done = self.compacted()
        have = [int(f.split("=")[1]) for f in folders(self.spark, f"{self.path}/delta")]
        return sorted(e for e in have if e > done and exists(self.spark, f"{self.path}/delta/_epoch={e}/_SUCCESS"))

    def _delta(self, epochs: list[int]) -> DataFrame:
        """The last row of each key in these epochs."""
        fields = StructType([*self.schema.fields, StructField("_epoch", LongType()), StructField("_bucket", IntegerType())])
        d = (self.spark.read.schema(fields).option("basePath", f"{self.path}/delta")
             .parquet(*[f"{self.path}/delta/_epoch={e}" for e in epochs]))
        return dedupe(d, self.key, ["_epoch", *self.order], keep="last").drop("_epoch")

    def _merged(self, base: DataFrame | None, delta: DataFrame) -> DataFrame:
        if base is None:
            return delta
        # The base has one row for each key: no dedupe, only what the deltas replace goes.
        on = [base[k].eqNullSafe(delta[k]) for k in self.key]
        return base.join(delta, on, "left_anti").unionByName(delta)

    def read(self) -> DataFrame:
        epochs = self.pending()
        base = self.base.read().select(*self.schema.names) if self.base.versions() else None
        if not epochs:
            return base if base is not None else self.spark.createDataFrame([], self.schema)
        return self._merged(base, self._delta(epochs).select(*self.schema.names))

    def compact(self, keep: int = 2) -> list[str]:
        """Merges the pending deltas into the buckets that they touch; returns
        those.  The deltas and versions beyond the newest ``keep`` are deleted
        after the commit."""
        epochs = self.pending()
        if not epochs:
            return []
        touched = sorted({f.split("=")[1] for e in epochs for f in folders(self.spark, f"{self.path}/delta/_epoch={e}")
                          if f.startswith("_bucket=")}, key=int)
        delta = self._delta(epochs)
        old = set(self.base.parts()) & set(touched)
        names = [*self.schema.names, "_bucket"]
        base = self.base.read(parts=old).withColumn("_bucket", self._bucket()) if old else None
        out = self._merged(base.select(*names) if base is not None else None, delta.select(*names))
        # The bucket is kept in the data only as the part's name.
        self.base.commit({"table": out.repartition("_bucket")}, part_by="_bucket", parts=touched,
                         info={"epoch": epochs[-1], "buckets": self.buckets})
        self._forget()
        self.base.vacuum(keep)
        return touched

    def _forget(self) -> None:
        done = self.compacted()
        for f in folders(self.spark, f"{self.path}/delta"):
            if int(f.split("=")[1]) <= done:
                delete(self.spark, f"{self.path}/delta/{f}")


class BatchedUpsert:
    """An upsert in batches of ``size`` rows that can be resumed.

    The rows are numbered once and kept with their batch.  Batches are sent in
    groups, each as one epoch of the target, and entered in a ledger after they
    are written, so a restart sends unfinished groups only; a group that was
    written and not entered replaces itself.  A group has ``group`` batches, or
    more where there would be over ``max_groups`` groups: each takes a fixed
    number of jobs, so the jobs don't grow with the rows."""

    def __init__(self, target: MergedTable, path: str, size: int = 500, group: int = 64, max_groups: int = 16):
        self.spark, self.target, self.size, self.group, self.max_groups = target.spark, target, size, group, max_groups
        self.path = path.rstrip("/")
        self.ledger_store = VersionedStore(self.spark, f"{self.path}/ledger")

    def plan(self, rows: DataFrame, order: Sequence[str]) -> None:
        """Numbers the rows; does nothing if that was done before."""
        if exists(self.spark, f"{self.path}/queue/_SUCCESS"):
            return
        # Epochs below this one hold what the target had before.
        first = max([self.target.compacted(), *self.target.pending()]) + 1
        q = global_index(rows, list(order), col="_pos")
        batches = -(-((q.agg(F.max("_pos")).first()[0] or 0) + 1) // self.size)
        group = max(self.group, -(-batches // self.max_groups))
        q = q.withColumn("batch_id", F.floor(F.col("_pos") / self.size).cast("long")).withColumn(
            "epoch", (F.floor(F.col("batch_id") / group) + first).cast("long")).drop("_pos")
        q.write.mode("overwrite").partitionBy("epoch").parquet(f"{self.path}/queue")

    def groups(self) -> list[int]:
        return sorted(int(f.split("=")[1]) for f in folders(self.spark, f"{self.path}/queue") if f.startswith("epoch="))

    def done(self) -> list[int]:
        return [int(p) for p in self.ledger_store.parts("batches")]

    def send(self, groups: int | None = None) -> int:
        """Sends groups that are not in the ledger, at most ``groups`` of
        them; returns how many."""
        todo = [g for g in self.groups() if g not in set(self.done())][:groups]
        for g in todo:
            rows = self.spark.read.parquet(f"{self.path}/queue/epoch={g}")
            self.target.write(rows.drop("batch_id"), g)
            entry = rows.groupBy("batch_id").agg(F.count("*").alias("rows")).select(
                "batch_id", "rows", F.lit("done").alias("state"), F.lit(g).cast("long").alias("epoch"))
            self.ledger_store.commit({"batches": entry}, run=f"group-{g}", part_by="epoch")
        return len(todo)

    def ledger(self) -> DataFrame:
        """(batch_id, rows, state) of all batches: done or pending."""
        queue = self.spark.read.parquet(f"{self.path}/queue").groupBy("batch_id").agg(F.count("*").alias("rows"))
        if not self.done():
            return queue.withColumn("state", F.lit("pending"))
        sent = self.ledger_store.read("batches").select("batch_id", "state")
        return queue.join(sent, "batch_id", "left").withColumn("state", F.coalesce("state", F.lit("pending")))
