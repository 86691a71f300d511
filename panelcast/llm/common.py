"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.session import apply_defaults, scratch_path

# Words of a text: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: whole texts travel in Arrow
    batches, so batches are bounded by rows and by bytes."""
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_owned: list[str] | None = None


@contextmanager
def scratch_owner(paths: list[str]):
    """Tables that ``durable`` writes meanwhile are entered in ``paths``, for
    ``release`` once what was made from them is written."""
    global _owned
    before, _owned = _owned, paths
    try:
        yield
    finally:
        _owned = before


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes scratch tables, in whatever store they lie."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    paths.clear()


def durable(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the cluster's shared folder and read back:
    later stages no longer depend on shuffle files of lost executors, and
    values that depend on partition order stay as they were written."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if _owned is not None:
        _owned.append(path)
    # Rows can hold whole texts or packed blocks, so row groups are kept small.
    df.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MAX_BITMAPS = 8192       # of 4 KB for 32,768 ids each: what a filter on row ids may broadcast


def flagged(rows: DataFrame, col: str, ids: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column ``name``: whether ``col`` is one of those
    of ``ids``.  By broadcast bitmaps, so that the rows need not move, while
    there are at most MAX_BITMAPS of them; by a shuffled join beyond."""
    # Ids move before they are added up: each task would have a bitmap for each bucket.
    ids = ids.select(col, F.bitmap_bucket_number(col).alias("_bucket"))
    bits = durable(ids.repartition("_bucket").groupBy("_bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(col)).alias("_bits")), "flag-bits")
    if bits.count() > MAX_BITMAPS:
        out = rows.join(ids.select(col, F.lit(True).alias(name)).distinct(), col, "left")
        return out.withColumn(name, F.coalesce(name, F.lit(False)))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(bitmap_bit_position({col}) div 8 as int) + 1, 1)")), 16, 10)
    bit = byte.cast("int").bitwiseAND(F.pow(F.lit(2), F.bitmap_bit_position(col) % 8).cast("int")) > 0
    return (rows.withColumn("_bucket", F.bitmap_bucket_number(col)).join(F.broadcast(bits), "_bucket", "left")
            .withColumn(name, F.coalesce(bit, F.lit(False))).drop("_bucket", "_bits"))


def quoted(name: str) -> Column:
    """The column of this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bundled(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with all columns but ``own`` in one struct _rest, so that their
    names can't clash with an operator's."""
    rest = [c for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*map(quoted, rest)).alias("_rest")) if rest else docs.select(*own)


def unbundled(df: DataFrame, columns: list[str], *own: str) -> DataFrame:
    return df.select(*[F.col(c) if c in own else F.col("_rest")[c].alias(c) for c in columns])


def map_rows(df: DataFrame, schema: StructType | str, fn: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """``mapInArrow`` with a function from one batch to a dict of columns."""
    empty = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(empty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if out is None:
                continue
            yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, empty)


def _array(values, kind):
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        a = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return a if a.type == kind else a.cast(kind)
    return pa.array(values, type=kind)


def texts(batch: pa.RecordBatch, name: str = "text") -> list:
    """The batch's texts, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]
