"""File sources and sinks: CSV (S1-S5), latest file (S14, S15), wide
report (S18), sinks (S21, S22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.dates import be_year


def read_csv(spark: SparkSession, path: str, schema: str | None = None, all_string: bool = False,
             date_format: str | None = None, with_file: bool = False) -> DataFrame:
    """Header CSV with an explicit schema (dates parsed with
    ``date_format``), or every column as text (``all_string``).  A UTF-8 BOM
    in the header is stripped by the reader."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if date_format:
        r = r.option("dateFormat", date_format)
    if schema:
        r = r.schema(schema)
    elif not all_string:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if with_file:
        df = df.select("*", F.col("_metadata.file_path").alias("_file_name"),
                       F.col("_metadata.file_modification_time").alias("_file_mtime"))
    return df


def format_decimals(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Floating columns rendered with a fixed number of decimals."""
    fmt = f"%.{decimals}f"
    return df.select(*[F.when(F.col(f.name).isNotNull(), F.format_string(fmt, F.col(f.name))).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, decimals: int | None = 2, mode: str = "overwrite") -> None:
    """Header CSV sink (no BOM)."""
    out = format_decimals(df, decimals) if decimals is not None else df
    out.write.mode(mode).option("header", True).csv(path)


def latest_snapshot_rows(df: DataFrame, by: str = "mtime", unit: str = "folder") -> DataFrame:
    """S14 (``by='mtime'``) / S15 (``by='name'``): the rows of the newest
    snapshot, from a scan read with ``with_file=True``.

    A snapshot is a folder with all its part files (``unit='folder'``, as
    Spark writes them) or one file (``unit='file'``).  Its time is that of its
    newest part; equal times are decided by name.  The newest snapshot is one
    aggregate row joined back (broadcast: one row)."""
    name = F.col("_file_name")
    snapshot = F.regexp_replace(name, "/[^/]*$", "") if unit == "folder" else name
    d = df.withColumn("_snapshot", snapshot)
    order = F.struct("_file_mtime", "_snapshot") if by == "mtime" else F.struct("_snapshot")
    newest = d.agg(F.max(order).alias("_top")).select(F.col("_top._snapshot").alias("_newest"))
    return d.join(F.broadcast(newest), d["_snapshot"] == newest["_newest"], "left_semi").drop("_snapshot")


def wide_report_to_long(df: DataFrame, id_cols: Sequence[str], month_cols: Sequence[str], year_col: str,
                        code_col: str | None = None, code: str | None = None, out: str = "value") -> DataFrame:
    """A report with one column per month -> (code, date, value).

    Preamble and header lines are dropped (their year is not a number),
    ``-`` and other text become NULL, the BE year is converted, and the
    optional ``code`` filter keeps one series.
    """
    year = F.col(year_col).cast("string").try_cast("int")
    d = df.filter(year.isNotNull())
    if code_col and code is not None:
        d = d.filter(F.trim(F.col(code_col)) == code)
    long = d.unpivot([*id_cols, year_col], list(month_cols), "_month_name", "_raw")
    month_idx = F.array_position(F.array(*[F.lit(m) for m in month_cols]), F.col("_month_name")).cast("int")
    y = be_year(F.col(year_col).cast("string").try_cast("int"))
    val = F.regexp_replace(F.trim(F.col("_raw").cast("string")), ",", "").try_cast("double")
    return long.select(*id_cols, F.make_date(y, month_idx, F.lit(1)).alias("date"), val.alias(out))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Table sink."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
