"""Numeric coercion and simple arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters stripped before parsing a price (comma, whitespace,
# the baht sign, the letters of the Thai word for baht, and T, H, B).
CURRENCY_NOISE_CLASS = r"[,\s฿บาทTHB]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    x = _col(c)
    return F.when(~F.isnan(x), x)


def to_number(c) -> Column:
    """coercing cast to DOUBLE; unparsable text and NaN -> NULL."""
    return nan_to_null(_col(c).cast("string").try_cast("double"))


def strip_thousands(c) -> Column:
    """drop commas and spaces, then coerce."""
    return to_number(F.translate(_col(c).cast("string"), ", ", ""))


def clean_numeric(c) -> Column:
    """F8: drop currency noise (character class), then coerce."""
    return to_number(F.regexp_replace(F.trim(_col(c).cast("string")), CURRENCY_NOISE_CLASS, ""))


def change(new, old) -> Column:
    """difference."""
    return _col(new) - _col(old)


def change_pct(new, old) -> Column:
    """percent change; NULL when the old value is 0 or NULL."""
    return F.try_divide(_col(new) - _col(old), _col(old)) * 100


def round2(c) -> Column:
    """two decimals, half-even on the decimal value."""
    return F.bround(_col(c), 2)


def in_range_or_null(c, lo: float, hi: float) -> Column:
    """Keep values within [lo, hi], NULL otherwise."""
    x = _col(c)
    return F.when(x.between(lo, hi), x)


def out_of_range(c, lo: float, hi: float) -> Column:
    """A non-null value outside [lo, hi] (for the violation count)."""
    x = _col(c)
    return x.isNotNull() & ~x.between(lo, hi)
