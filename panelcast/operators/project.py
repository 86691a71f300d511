"""Projections, renames and row filters.

Column resolution (P2-P5) works on ``df.schema`` only - no data pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from ..config import LEGACY_SUFFIXES
from ..functions.numbers import in_range_or_null, out_of_range


def to_series(df: DataFrame, time: str, value: str, name: str, out_time: str = "date") -> DataFrame:
    """Project to ``(date, name)``."""
    return df.select(F.col(time).alias(out_time), F.col(value).alias(name))


def resolve_column(schema: StructType, candidates: Sequence[str], fallback: str | None = "last_numeric",
                   exclude: Iterable[str] = ()) -> str | None:
    """First candidate present in the schema; otherwise the last (or
    first) numeric column, skipping ``exclude``."""
    names = [f.name for f in schema.fields]
    for c in candidates:
        if c in names:
            return c
    skip = set(exclude)
    numeric = [f.name for f in schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]
    if not numeric or fallback is None:
        return None
    return numeric[-1] if fallback == "last_numeric" else numeric[0]


def rename_legacy(df: DataFrame, suffixes: dict[str, str] = LEGACY_SUFFIXES) -> DataFrame:
    """``x_roll7`` -> ``x_roll7_mean``, ``x_pct`` -> ``x_pct_change``
    for any column; skipped when the new name already exists."""
    cols = set(df.columns)
    mapping = {}
    for c in df.columns:
        for old, new in suffixes.items():
            if c.endswith(old):
                target = c[: -len(old)] + new
                if target not in cols and target not in mapping.values():
                    mapping[c] = target
    return df.withColumnsRenamed(mapping) if mapping else df


def drop_prefixed(df: DataFrame, prefix: str = "Unnamed:") -> DataFrame:
    """Drop columns whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def conform(df: DataFrame, columns: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """Add missing columns as NULL and enforce the column order."""
    types = types or {}
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string")).alias(c)
                       for c in columns])


def add_ingest_columns(df: DataFrame, source: str | None = None, now: Column | None = None) -> DataFrame:
    """Ingest timestamp (and source literal)."""
    out = df.withColumn("timestamp", now if now is not None else F.current_timestamp())
    return out.withColumn("source_url", F.lit(source)) if source is not None else out


def positive(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with a positive value."""
    return df.filter(F.col(col) > 0)


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows with at least one non-null value among ``cols``."""
    return df.filter(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def range_rule(df: DataFrame, col: str, lo: float, hi: float, count_col: str | None = None) -> DataFrame:
    """NULL out values outside [lo, hi]; optionally flag violations
    (already-NULL values are not violations) in ``count_col``."""
    out = df
    if count_col:
        out = out.withColumn(count_col, out_of_range(col, lo, hi))
    return out.withColumn(col, in_range_or_null(col, lo, hi))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten struct columns into ``parent_child`` top-level columns."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            cols += [F.col(f"`{f.name}`.`{s.name}`").alias(f"{f.name}{sep}{s.name}") for s in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
