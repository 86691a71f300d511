"""Embedding whitening with MLlib block matrices.

Entries become whole numbers x = floor(scale * c).  Each distinct vector counts
once for the mean and the covariance (the fit list).  Rows are numbered and
dealt into blocks; the centred blocks form a BlockMatrix whose product with its
transpose is the scatter matrix.  Its eigenvectors are computed on the driver
(dimensions x dimensions), and the product of all centred rows with the
whitening matrix, again of block matrices, projects the rows.

MLlib's product keeps the coordinates of all blocks on the driver, so a block
takes more rows where there are many: one block for some 65,000th of the rows,
between 1,024 and 65,536 rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import durable

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = (1024, 65_536)
BLOCKS = 65_536          # blocks are made larger beyond this number of them
GROUP_BLOCKS = 16        # blocks whose products are summed in one task before they are merged
_KEY = StructType([StructField("row", LongType()), StructField("col", LongType())])


@dataclass(frozen=True)
class Whitening:
    """What was fitted: vectors of the fit list, their sums and centre, unit
    eigenvectors as columns with falling eigenvalues, and the trace of the
    covariance."""
    n: int
    sums: list[int]
    mean: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def matrix(self, k: int) -> np.ndarray:
        """Whitening matrix of the first ``k`` components; zeros for those
        without variance."""
        e = self.values[:k]
        live = self.live(k)
        return self.vectors[:, :k] * np.where(live, 1 / np.sqrt(np.where(live, e, 1.0)), 0.0)

    def live(self, k: int) -> np.ndarray:
        return self.values[:k] > len(self.mean) * np.finfo(float).eps * self.trace


def _quantized(rows: DataFrame, scale: float) -> DataFrame:
    """(id, x as int64 bytes, digest of x, length) of rows (id, v)."""
    kind = rows.schema["id"].dataType.simpleString()
    v = F.transform("v", lambda c: c.cast("double"))
    ok = F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    edge = 2.0 ** 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            sizes = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            flat = np.floor(scale * col.flatten().to_numpy(zero_copy_only=False).astype(float))
            inside = (flat >= -edge) & (flat < edge)
            x = np.where(inside, flat, 0).astype(np.int64)
            x[flat >= edge], x[flat < -edge] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
            data = [x[a:e].tobytes() for a, e in zip(ends[:-1], ends[1:], strict=True)]
            # Zeros at the end don't count, so that a short vector equals its longer form.
            same = [hashlib.blake2b(t.rstrip(b"\0"), digest_size=16).digest() for t in data]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(data, pa.binary()), pa.array(same, pa.binary()),
                                              pa.array(sizes, pa.int32())], names=["id", "x", "same", "d"])

    return (rows.where(F.coalesce(ok, F.lit(False))).select("id", v.alias("v"))
            .mapInArrow(run, f"id {kind}, x binary, same binary, d int"))


def _into_blocks(x: DataFrame) -> tuple[DataFrame, int, int, int]:
    """Blocks of consecutively numbered rows, (b, rows: array of (p, id, x) by
    position p, fit: positions of the first row of each distinct vector), with
    the numbers of rows, of dimensions and of rows in a block."""
    spark = x.sparkSession
    x = durable(x.withColumn("rid", F.monotonically_increasing_id()), "whiten-rows")
    # Row numbers without gaps: a count for each partition that was written.
    part = F.shiftright("rid", 33)
    counts = sorted(x.groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.max("d").alias("d")).collect())
    total, starts = 0, []
    for r in counts:
        starts.append((r["p"], total))
        total += r["n"]
    per_block = min(max(-(-total // BLOCKS), BLOCK_ROWS[0]), BLOCK_ROWS[1])
    offsets = spark.createDataFrame(starts, "part long, start long")
    d = (x.withColumn("part", part).join(F.broadcast(offsets), "part")
         .withColumn("at", F.col("start") + F.col("rid").bitwiseAND(F.lit((1 << 33) - 1))))
    b, p = F.floor(F.col("at") / per_block).cast("int").alias("b"), F.pmod("at", F.lit(per_block)).cast("int").alias("p")
    fit = (d.groupBy("same").agg(F.min("at").alias("at")).select(b, p)
           .groupBy("b").agg(F.collect_list("p").alias("fit")))
    rows = d.select(b, F.struct(p, "id", "x").alias("r")).groupBy("b").agg(F.sort_array(F.collect_list("r")).alias("rows"))
    return durable(rows.join(fit, "b", "left"), "whiten-blocks"), total, max([r["d"] for r in counts], default=0), per_block


def _matrix(xs: list[bytes], d: int) -> np.ndarray:
    """The vectors as rows; shorter ones end in zeros."""
    if all(len(x) == 8 * d for x in xs):
        return np.frombuffer(b"".join(xs), np.int64).reshape(len(xs), d)
    return np.frombuffer(b"".join(x.ljust(8 * d, b"\0") for x in xs), np.int64).reshape(len(xs), d)


def _xs(rows: pa.StructScalar) -> list[bytes]:
    return rows.values.field("x").to_pylist()


def _sums(blocks: DataFrame, d: int) -> tuple[int, list[int]]:
    """Vectors of the fit list and their exact sums in each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for b in batches:
            for rows, fit in zip(b.column("rows"), b.column("fit").to_pylist(), strict=True):
                if fit:
                    x = _matrix(_xs(rows), d)[fit]
                    n += len(x)
                    # In halves, so that no sum of a block leaves 64 bits.
                    total += (x >> 32).sum(0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([str(v) for v in [n, *total]])],
                                         names=["j", "s"])

    got = {r["j"]: int(r["s"]) for r in blocks.mapInArrow(run, "j int, s string").groupBy("j")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return got.get(-1, 0), [got.get(j, 0) for j in range(d)]


def _matrices(x: list[np.ndarray], d: int) -> pa.StructArray:
    """Matrices with ``d`` columns in the storage form of MLlib's type."""
    flat = np.concatenate([m.ravel("F") for m in x])
    ends = np.cumsum([0, *(m.size for m in x)]).astype(np.int32)
    n = len(x)
    return pa.StructArray.from_arrays(
        [pa.array([1] * n, pa.int8()), pa.array([len(m) for m in x], pa.int32()), pa.array([d] * n, pa.int32()),
         pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int32())),
         pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array([False] * n)],
        names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"])


def _centred(blocks: DataFrame, mean: np.ndarray) -> DataFrame:
    """(key, every, fit): the centred rows of each block as a matrix, and the
    same with zeros in the rows outside the fit list, which add nothing to a
    product.  Written once, since MLlib reads its blocks several times."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, rows, fit in zip(b.column("b").to_pylist(), b.column("rows"), b.column("fit").to_pylist(), strict=True):
                every = _matrix(_xs(rows), d) - mean
                only = np.zeros_like(every)
                only[fit or []] = every[fit or []]
                key = pa.StructArray.from_arrays([pa.array([at], pa.int64()), pa.array([0], pa.int64())], names=["row", "col"])
                yield pa.RecordBatch.from_arrays([key, _matrices([every], d), _matrices([only], d)],
                                                 names=["key", "every", "fit"])

    schema = StructType([StructField("key", _KEY), StructField("every", MatrixUDT()), StructField("fit", MatrixUDT())])
    return durable(blocks.mapInArrow(run, schema), "whiten-centred")


def _block_matrix(blocks: DataFrame, rows: int, cols: int, per_block: int) -> BlockMatrix:
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, per_block, cols, rows, cols), per_block, cols)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """transpose(A) * A.  The inner dimension is cut into groups of blocks, so
    that no task holds more than a group of them."""
    t = matrix.transpose()
    groups = max(1, -(-matrix.numRows() // (matrix.rowsPerBlock * GROUP_BLOCKS)))
    product = t._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(product, t.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def fit_project(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: float = SCALE,
                components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """The whitening of the column ``vector`` and, for each row that is left,
    (id, fit, deviation, z): whether the row is the fit list's copy of its
    vector, the exact squared distance of n times the vector from the sums
    (null beyond a long), and the whitened vector of the first ``components``.

    Rows whose vector is null or holds null or non-finite entries go; an empty
    vector, and one shorter than the longest, counts as ending in zeros;
    entries beyond a long saturate.  Repeated rows stay rows of their own.
    Other columns are not used.  Without rows the fit has no dimensions."""
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType
    blocks, total, d, per_block = _into_blocks(_quantized(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), scale))
    out = f"id {kind.simpleString()}, fit boolean, deviation long, z array<double>"
    if d == 0:
        none = np.zeros(0)
        n = 1 if total else 0
        plain = blocks.select(F.explode("rows").alias("r"), "fit").select(
            "r.id", F.array_contains("fit", F.col("r.p")).alias("fit"), F.lit(0).cast("long").alias("deviation"),
            F.array().cast("array<double>").alias("z"))
        return Whitening(n, [], none, np.zeros((0, 0)), none, 0.0), plain
    n, sums = _sums(blocks, d)
    mean = np.array([s / n for s in sums])
    centred = _centred(blocks, mean)
    v = scatter(_block_matrix(centred.select("key", "fit"), total, d, per_block)) / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    model = Whitening(n, sums, mean, vectors[:, ::-1], np.maximum(values[::-1], 0.0), float(np.trace(v)))

    k = min(components, d)
    w = model.matrix(k)
    # One block of d x k; MLlib wants the same number of rows in it as columns in the others.
    key = spark.createDataFrame([((0, 0), Matrices.dense(d, k, w.ravel("F")))],
                                StructType([StructField("key", _KEY), StructField("m", MatrixUDT())]))
    whitening = BlockMatrix(callMLlibFunc("createBlockMatrix", key, d, k, d, k), d, k)
    product = _block_matrix(centred.select("key", "every"), total, d, per_block).multiply(whitening)
    z = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).toDF("key", "m")
    z = z.select(F.col("key")[z.schema["key"].dataType.names[0]].cast("int").alias("b"), "m")
    live = model.live(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(sums, object)
        small = np.array(sums, np.int64) if max(map(abs, sums)) < 1 << 62 else None
        for b in batches:
            for rows, fit, m in zip(b.column("rows"), b.column("fit").to_pylist(), b.column("m"), strict=True):
                x = _matrix(_xs(rows), d)
                values = m["values"].values.to_numpy()
                white = values.reshape(len(x), k) if m["isTransposed"].as_py() else values.reshape(k, len(x)).T
                if small is not None and (float(n) * np.abs(x.astype(float)).max(initial=0) + float(max(map(abs, sums)))) ** 2 * d < 2.0 ** 62:
                    far = ((n * x - small) ** 2).sum(1).tolist()
                else:
                    far = [int(f) if f < 1 << 63 else None for f in ((n * x.astype(object) - s) ** 2).sum(1)]
                z = np.where(live, white, np.nan)
                cells = pa.array(z.ravel(), from_pandas=True)              # no variance: null
                used = np.zeros(len(x), bool)
                used[fit or []] = True
                yield pa.RecordBatch.from_arrays(
                    [rows.values.field("id"), pa.array(used), pa.array(far, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(x) + 1, k), pa.int32()), cells)],
                    names=["id", "fit", "deviation", "z"])

    return model, durable(blocks.join(z, "b").mapInArrow(run, out), "whiten-projected")


def identity_error(projected: DataFrame, k: int, live: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance (centred,
    divisor n) minus the identity, over the components with variance."""
    pairs = [(i, j) for i in range(k) for j in range(i, k) if live[i] and live[j]]
    if not pairs:
        return 0.0
    z = projected.where("fit").select(*[F.col("z")[i].alias(f"z{i}") for i in range(k)])
    got = z.agg(*[F.covar_pop(f"z{i}", f"z{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def report(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error)
    of each row that is left and each component that the vectors have, see
    ``fit_project``.  ``whitened`` is null and ``explained`` 0 for a component
    without variance."""
    model, projected = fit_project(rows, id_col, vector, **options)
    k = min(options.get("components", COMPONENTS), len(model.mean))
    error = identity_error(projected, k, model.live(k))
    share = F.array(*[F.lit(float(e / model.trace) if model.trace > 0 else 0.0) for e in model.values[:k]]).cast("array<double>")
    return projected.select("id", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        F.col("id").alias(id_col), (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(share, F.col("i")).alias("explained"), F.lit(float(error)).alias("identity_error"))
