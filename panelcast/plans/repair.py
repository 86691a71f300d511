"""Repair pipelines (Q8 gold, Q9 FX, Q10 light gold cleaning).

Each returns ``(clean, rejected)``; ``rejected`` keeps the rows dropped for a
missing date or missing values so they can be written to a side table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FX_RANGE, GOLD_RANGE, OUTLIER_IQR_THRESHOLD, OUTLIER_MIN_SUPPORT
from ..functions.dates import with_parsed_date
from ..functions.numbers import clean_numeric, in_range_or_null, out_of_range, strip_thousands
from ..operators.dedupe import dedupe
from ..operators.stats import outlier_flags


def repair_gold(raw: DataFrame, date_col: str, price_cols: Sequence[str], seq, outlier_col: str | None = None,
                bounds: tuple[float, float] = GOLD_RANGE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q8: F1-F3 date parse -> F8 numbers -> P12 range rule -> P9 date
    present -> P13 any price -> W9 keep last per date -> A16 outliers.

    Returns (clean, rejected, violations) where violations counts the
    out-of-range values per price column (NULL inputs excluded).
    """
    lo, hi = bounds
    d = with_parsed_date(raw, date_col, "date")
    d = d.withColumns({c: clean_numeric(c) for c in price_cols})
    ranged = {c: in_range_or_null(c, lo, hi) for c in price_cols}
    ok_expr = F.col("date").isNotNull() & F.coalesce(*ranged.values()).isNotNull()
    # One aggregate (no Filter to push into the parse) counts violations per
    # column and rejected rows.
    violations = d.agg(*[F.count_if(out_of_range(c, lo, hi)).alias(c) for c in price_cols],
                       F.count_if(~ok_expr).alias("rejected"))
    d = d.withColumns(ranged)
    ok = F.col("date").isNotNull() & F.coalesce(*[F.col(c) for c in price_cols]).isNotNull()
    rejected = d.filter(~ok)
    clean = dedupe(d, "date", seq, keep="last", where=ok)
    if outlier_col:
        # The outlier step reads its input three times (percentiles, support
        # count, flags); the de-duplicated table has one row per date, so it
        # is checkpointed once and the parse runs a single time.
        clean = outlier_flags(clean.checkpoint(), outlier_col, (), "iqr", OUTLIER_IQR_THRESHOLD,
                              OUTLIER_MIN_SUPPORT)
    return clean, rejected, violations


def repair_fx(raw: DataFrame, key: Sequence[str], rate_col: str, seq, bounds: tuple[float, float] = FX_RANGE
              ) -> tuple[DataFrame, DataFrame]:
    """Q9: coerce the rate, NULL it outside the range, drop rows without a
    rate, keep the last row per key."""
    lo, hi = bounds
    d = raw.withColumn(rate_col, in_range_or_null(clean_numeric(rate_col), lo, hi))
    ok = F.col(rate_col).isNotNull()
    return dedupe(d, list(key), seq, keep="last", where=ok), d.filter(~ok)


def clean_gold_light(raw: DataFrame, date_col: str, price_col: str, seq) -> tuple[DataFrame, DataFrame]:
    """Q10: comma-stripped number (F7), drop NULLs (P9), positive (P11),
    keep the last row per date (W9)."""
    d = with_parsed_date(raw.withColumn(price_col, strip_thousands(price_col)), date_col, "date")
    ok = F.col("date").isNotNull() & F.col(price_col).isNotNull() & (F.col(price_col) > 0)
    return dedupe(d, "date", seq, keep="last", where=ok), d.filter(~ok)
