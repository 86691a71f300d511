"""Date and time parsing as Column expressions (no Python in the data path).

Every function takes and returns ``Column`` objects so Catalyst keeps them in
whole-stage codegen.  Failures become NULL (``try_*`` functions; ANSI mode is
on in Spark 4, where a plain cast or ``to_date`` would raise).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BE_YEAR_CUTOFF, BE_YEAR_OFFSET

# Thai month names in calendar order (January..December).
THAI_MONTHS = (
    "มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน",
    "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม",
)

# Formats tried, in order, by the fallback parser.
FALLBACK_FORMATS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "d MMM yyyy", "MMM d, yyyy",
)
# Shape of the text each format can parse.  A format is only tried on text
# of its shape: a failed parse costs a JVM exception per row, a regex test
# does not.
FORMAT_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    "MMM d, yyyy": r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
}

_SLASH_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
_TIME_HM = r"(\d{1,2}:\d{2})"
_DATE_IN_TEXT = r"(\d{1,2}/\d{1,2}/\d{4})"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def be_year(year: Column) -> Column:
    """Buddhist-era year to Gregorian: years above 2400 lose 543."""
    return F.when(year > BE_YEAR_CUTOFF, year - BE_YEAR_OFFSET).otherwise(year)


def _ymd_to_date(y: Column, m: Column, d: Column) -> Column:
    # Year arithmetic happens on the parts before parsing, so 29/02/2567
    # becomes 2024-02-29 (2567 itself is not a leap year).
    return F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"),
                                     m.cast("string"), d.cast("string")), "y-M-d")


def parse_be_slash_date(s) -> Column:
    """``dd/mm/yyyy`` in Buddhist or Common era -> DATE; failure -> NULL."""
    t = F.trim(_col(s))
    y = F.regexp_extract(t, _SLASH_DATE, 3).try_cast("int")
    m = F.regexp_extract(t, _SLASH_DATE, 2).try_cast("int")
    d = F.regexp_extract(t, _SLASH_DATE, 1).try_cast("int")
    return F.when(t.rlike(_SLASH_DATE), _ymd_to_date(be_year(y), m, d))


def thai_month_number(name) -> Column:
    """Thai month name -> 1..12, unknown -> NULL."""
    pairs = []
    for i, mname in enumerate(THAI_MONTHS, start=1):
        pairs += [F.lit(mname), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), _col(name))


def parse_thai_long_date(s) -> Column:
    """``26 พฤศจิกายน 2568`` -> 2025-11-26; unknown month -> NULL."""
    parts = F.split(F.trim(_col(s)), r"\s+")
    day = F.try_element_at(parts, F.lit(1)).try_cast("int")
    month = thai_month_number(F.try_element_at(parts, F.lit(2)))
    year = F.try_element_at(parts, F.lit(3)).try_cast("int")
    return F.when(F.size(parts) == 3, _ymd_to_date(be_year(year), month, day))


_YEAR_TOKEN = r"(?<!\d)(\d{4})(?!\d)"


def be_corrected_text(t: Column, year: Column | None = None) -> Column:
    """Replace a Buddhist-era year token (4 digits above 2400) by its
    Gregorian value inside the text; ``year`` is the extracted token as INT
    when the caller already has it."""
    y = year if year is not None else F.regexp_extract(t, _YEAR_TOKEN, 1).try_cast("int")
    return F.when(y > BE_YEAR_CUTOFF, F.replace(t, y.cast("string"), (y - BE_YEAR_OFFSET).cast("string"))).otherwise(t)


def parse_formats(t: Column, formats: Iterable[str] = FALLBACK_FORMATS) -> Column:
    tries = []
    for f in formats:
        parsed = F.try_to_timestamp(t, F.lit(f))
        shape = FORMAT_SHAPES.get(f)
        tries.append(F.when(t.rlike(shape), parsed) if shape else parsed)
    return F.to_date(F.coalesce(*tries))


def parse_any_date(s, formats: Iterable[str] = FALLBACK_FORMATS) -> Column:
    """fallback parse with an explicit format list.

    A Buddhist-era year is converted in the text before parsing, as in F1,
    so BE leap days such as 2543-02-29 resolve to 2000-02-29 instead of
    failing (2543 is not a leap year).  For large format lists prefer
    ``with_parsed_date``, which computes the corrected text once.
    """
    return parse_formats(be_corrected_text(F.trim(_col(s))), formats)


def parse_thai_date(s) -> Column:
    """F1 -> F2 -> F3 in order, as the reference's repair step does."""
    return F.coalesce(parse_be_slash_date(s), parse_thai_long_date(s), parse_any_date(s))


def with_parsed_date(df, src: str, out: str = "date", formats: Iterable[str] = FALLBACK_FORMATS):
    """DataFrame form of ``parse_thai_date`` in staged projections: the
    trimmed and the BE-corrected texts are columns computed once (Catalyst
    does not inline a regex projection referenced several times), which
    keeps the generated code of the stage small."""
    staged = (df.withColumn("_pd_t", F.trim(F.col(src)))
              .withColumn("_pd_y", F.regexp_extract(F.col("_pd_t"), _YEAR_TOKEN, 1).try_cast("int"))
              .withColumn("_pd_fix", be_corrected_text(F.col("_pd_t"), F.col("_pd_y"))))
    parsed = F.coalesce(parse_be_slash_date(F.col("_pd_t")), parse_thai_long_date(F.col("_pd_t")),
                        parse_formats(F.col("_pd_fix"), formats))
    return staged.withColumn(out, parsed).drop("_pd_t", "_pd_y", "_pd_fix")


def normalize_time(s) -> Column:
    """first ``H:MM`` inside the text -> ``H:MM:00``; none -> NULL."""
    hm = F.regexp_extract(F.trim(_col(s)), _TIME_HM, 1)
    return F.when(hm != "", F.concat(hm, F.lit(":00")))


def extract_slash_date(s) -> Column:
    """first ``d/m/yyyy`` found in a text, or NULL."""
    found = F.regexp_extract(_col(s), _DATE_IN_TEXT, 1)
    return F.when(found != "", found)


def assemble_datetime(date_col, time_col, now: Column | None = None) -> Column:
    """Gregorian date + ``HH:mm:ss`` -> TIMESTAMP_NTZ, else ``now``."""
    text = F.concat_ws(" ", F.date_format(_col(date_col), "yyyy-MM-dd"), _col(time_col))
    ts = F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm:ss")).cast("timestamp_ntz")
    fallback = now if now is not None else F.localtimestamp()
    return F.coalesce(ts, fallback.cast("timestamp_ntz"))


def month_start(period) -> Column:
    """``yyyy-MM`` period -> first day of that month; failure -> NULL."""
    return F.try_to_date(F.concat(_col(period), F.lit("-01")), "y-M-d")


def parse_date(s, fmt: str = "MM/dd/yyyy") -> Column:
    """date with an explicit format (default US), failure -> NULL."""
    return F.try_to_date(_col(s), fmt)


def epoch_ms_to_date(ms) -> Column:
    """epoch milliseconds -> DATE (in the pinned session zone, UTC)."""
    return F.to_date(F.timestamp_millis(_col(ms).cast("long")))


def date_to_iso(d) -> Column:
    """DATE -> ``yyyy-MM-dd``."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def weekday_name(d) -> Column:
    """full English weekday name."""
    return F.date_format(_col(d), "EEEE")


def weekday_number(d) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(_col(d))


def is_open_day(d, closed_weekdays: Iterable[int]) -> Column:
    """F16: the market is open unless the weekday is in ``closed_weekdays``."""
    closed = list(closed_weekdays)
    if not closed:
        return F.lit(True)
    return ~F.weekday(_col(d)).isin(closed)


def next_open_day(d, closed_weekdays: Iterable[int]) -> Column:
    """first day after ``d`` that is not closed (looks one week ahead)."""
    closed = list(closed_weekdays)
    if len(set(closed)) >= 7:
        raise ValueError("a calendar closed on all seven weekdays has no open day")
    ahead = F.transform(F.sequence(F.lit(1), F.lit(7)), lambda n: F.date_add(_col(d), n))
    if closed:
        ahead = F.filter(ahead, lambda x: ~F.weekday(x).isin(closed))
    return F.element_at(ahead, 1)


def next_day(d, closed_weekdays: Iterable[int] = (), skip_closed: bool = True) -> Column:
    if skip_closed and list(closed_weekdays):
        return next_open_day(d, closed_weekdays)
    return F.date_add(_col(d), 1)


def age_days(d, as_of) -> Column:
    """whole days between ``d`` and ``as_of``."""
    return F.datediff(_col(as_of), _col(d))


def to_be_slash(d) -> Column:
    """Inverse of F1, used to synthesise raw strings: DATE -> ``dd/MM/yyyy`` (BE)."""
    dd = _col(d)
    return F.format_string("%02d/%02d/%04d", F.dayofmonth(dd), F.month(dd), F.year(dd) + BE_YEAR_OFFSET)


def to_thai_long(d) -> Column:
    """Inverse of F2: DATE -> ``d <Thai month> yyyy`` (BE)."""
    dd = _col(d)
    names = F.array(*[F.lit(m) for m in THAI_MONTHS])
    return F.concat_ws(" ", F.dayofmonth(dd).cast("string"), F.element_at(names, F.month(dd)),
                       (F.year(dd) + BE_YEAR_OFFSET).cast("string"))
