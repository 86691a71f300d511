"""Data-quality rules.

A rule set is evaluated as rows ``(rule, status, detail)``: schema rules are
decided from ``df.schema`` (no data pass); data rules are aggregate
expressions evaluated together in ONE ``agg`` over the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


@dataclass(frozen=True)
class Rule:
    """A named check.  ``passed`` is an aggregate boolean Column;
    ``detail`` an aggregate Column rendered as text; failures get
    ``severity`` (FAIL or WARN)."""
    name: str
    passed: Column
    detail: Column | None = None
    severity: str = FAIL


def evaluate(df: DataFrame, rules: Sequence[Rule], static: Sequence[tuple[str, bool, str, str]] = ()) -> DataFrame:
    """Evaluate data rules in one aggregate, union schema rules, return
    ``(rule, status, detail)`` rows."""
    spark = df.sparkSession
    parts = []
    if rules:
        aggs = []
        for i, r in enumerate(rules):
            aggs += [r.passed.alias(f"p{i}"), (r.detail if r.detail is not None else F.lit("")).cast("string").alias(f"d{i}")]
        row = df.agg(*aggs)
        stack = ", ".join(f"'{r.name}', p{i}, '{r.severity}', d{i}" for i, r in enumerate(rules))
        long = row.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, passed, severity, detail)")
        parts.append(long)
    if static:
        parts.append(spark.createDataFrame(list(static), "rule string, passed boolean, severity string, detail string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = F.when(F.coalesce(F.col("passed"), F.lit(False)), PASS).otherwise(F.col("severity"))
    return out.select("rule", status.alias("status"), "detail")


def schema_rules(df: DataFrame, required: Sequence[str], optional: Sequence[str] = (), numeric: bool = True,
                 time: str = "date", severity: str = FAIL, any_of: Sequence[str] = ()) -> list[tuple[str, bool, str, str]]:
    """Q1/Q4/Q5 schema part: time column, required columns, at least one of
    ``any_of`` (price columns), numeric types."""
    cols = set(df.columns)
    missing = [c for c in required if c not in cols]
    out = [(f"has_{time}", time in cols, severity, ""),
           ("required_columns", not missing, severity, ",".join(missing))]
    if optional:
        absent = [c for c in optional if c not in cols]
        out.append(("optional_columns", not absent, WARN, ",".join(absent)))
    if any_of:
        present = [c for c in any_of if c in cols]
        out.append(("any_column", bool(present), severity, ",".join(present)))
    if numeric:
        types = {f.name: f.dataType for f in df.schema.fields}
        bad = [c for c in required if c in types and c != time and not isinstance(types[c], NumericType)]
        out.append(("numeric_types", not bad, severity, ",".join(bad)))
    return out


def feature_store_rules(df: DataFrame, time: str = "date", entity: Sequence[str] = (),
                        cols: Sequence[str] | None = None) -> list[Rule]:
    """Q1 data part: time monotonic within entity in arrival order (checked
    as row-count == distinct sorted keys), unique, no NULLs."""
    cols = [c for c in (cols or df.columns) if c != time and c not in entity]
    keys = [*entity, time]
    n = F.count(F.lit(1))
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    return [
        Rule("unique_key", n == F.count_distinct(F.struct(*keys)),
             (n - F.count_distinct(F.struct(*keys))).cast("string")),
        Rule("no_nulls", nulls == 0, nulls.cast("string")),
        Rule("non_empty", n > 0, n.cast("string")),
    ]


def monotonic_rule(df: DataFrame, time: str, seq: str, entity: Sequence[str] = ()) -> DataFrame:
    """Q1: ``time`` non-decreasing in arrival order ``seq`` (per entity) as a
    rule row, the detail the number of entities that break it; uses the distributed arrival-order check (W19)."""
    from .split import series_checks
    checks = series_checks(df, time, seq, entity)
    bad = F.count_if(~F.col("monotonic"))
    return evaluate(checks, [Rule("monotonic", bad == 0, bad.cast("string"))])


def loose_validation(df: DataFrame, required: Sequence[str], as_of, time: str = "date", max_age_days: int = 7) -> DataFrame:
    """Q2: one row for the required columns (FAIL with the missing names), one
    for each required column that is there (WARN with its NULL count) and one
    for the age of the newest row at ``as_of`` (WARN beyond ``max_age_days``;
    an empty table is stale).  One aggregate over the table."""
    here = [c for c in required if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    nulls = {c: F.count_if(F.col(c).isNull()) for c in here}
    rules = [Rule(f"nulls_{c}", n == 0, n.cast("string"), WARN) for c, n in nulls.items()]
    if time in here:
        age = F.datediff(F.lit(as_of).cast("date"), F.max(time))
        rules.append(Rule("freshness", age <= max_age_days, age.cast("string"), WARN))
    return evaluate(df, rules, [("required_columns", not missing, FAIL, ",".join(missing))])


def readiness(df: DataFrame, features: Sequence[str], null_warn_pct: float = 50.0) -> DataFrame:
    """Q6: per expected feature - MISSING (no column), ALL_NULL, HIGH_NULL
    (more than ``null_warn_pct`` % NULL) or OK, with the NULL percent."""
    present = [c for c in features if c in df.columns]
    absent = [c for c in features if c not in df.columns]
    spark = df.sparkSession
    parts = []
    if present:
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
        long = row.unpivot(["_n"], present, "feature", "nulls")
        pct = F.when(F.col("_n") > 0, F.col("nulls") * 100.0 / F.col("_n")).otherwise(F.lit(100.0))
        long = long.withColumn("null_pct", pct).withColumn(
            "status", F.when(F.col("nulls") == F.col("_n"), "ALL_NULL")
            .when(F.col("null_pct") > null_warn_pct, "HIGH_NULL").otherwise("OK")).drop("_n", "nulls")
        parts.append(long.select("feature", "status", "null_pct"))
    if absent:
        parts.append(spark.createDataFrame([(c, "MISSING", None) for c in absent],
                                           "feature string, status string, null_pct double"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def acceptance_rules(df: DataFrame, value: str, time: str = "date", entity: Sequence[str] = (),
                     min_rows: int = 500, min_std: float = 1000.0, max_gaps: int = 10, gap_days: int = 7) -> DataFrame:
    """Q7: dataset acceptance - rows, spread, no NULLs, no duplicate dates,
    few long gaps - evaluated in one aggregate (gaps need one window)."""
    w = (Window.partitionBy(*entity) if entity else Window.partitionBy()).orderBy(time)
    d = df.withColumn("_gap", F.datediff(F.col(time), F.lag(time).over(w)))
    n = F.count(F.lit(1))
    rules = [
        Rule("min_rows", n >= min_rows, n.cast("string")),
        Rule("min_std", F.stddev_samp(value) >= min_std, F.round(F.stddev_samp(value), 2).cast("string")),
        Rule("no_nulls", F.count_if(F.col(value).isNull()) == 0, F.count_if(F.col(value).isNull()).cast("string")),
        Rule("no_duplicates", n == F.count_distinct(F.struct(*entity, time)),
             (n - F.count_distinct(F.struct(*entity, time))).cast("string")),
        Rule("few_gaps", F.count_if(F.col("_gap") > gap_days) <= max_gaps,
             F.count_if(F.col("_gap") > gap_days).cast("string")),
    ]
    return evaluate(d, rules)


def table_presence(spark: SparkSession, tables: dict[str, DataFrame | None], required: Sequence[str]) -> DataFrame:
    """Q3: per source - present and non-empty (``limit(1)`` probe per table,
    reading at most one row group)."""
    rows = []
    for name, df in tables.items():
        ok = df is not None and len(df.limit(1).take(1)) == 1
        sev = FAIL if name in required else WARN
        rows.append((name, ok, sev, "" if ok else ("missing" if df is None else "empty")))
    return evaluate(spark.createDataFrame([], "x int"), [], rows) if rows else None


def health_summary(results: DataFrame) -> DataFrame:
    """Q12: counts of PASS / WARN / FAIL and the overall status."""
    c = results.groupBy("status").count()
    return c.groupBy().pivot("status", [PASS, WARN, FAIL]).sum("count").na.fill(0).withColumn(
        "overall", F.when(F.col(FAIL) > 0, "UNHEALTHY").when(F.col(WARN) > 0, "DEGRADED").otherwise("HEALTHY"))
