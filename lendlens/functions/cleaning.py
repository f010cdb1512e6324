"""Column expressions for turning landed text into typed values.

All are built-in Spark expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's string->double cast also accepts a Java float/double suffix
# ("1d", "2.5F"); SQL engines reject it.  Such text must stay NULL.
_JAVA_SUFFIX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]\s*$"
# SQL engines read a single underscore between digits as a digit separator
# ("1_000" -> 1000); Spark's cast does not.
_DIGIT_SEPARATOR = r"(?<=\d)_(?=\d)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c) -> Column:
    """Text -> double, NULL when the text is not a number.

    Separators and suffixes are only looked for in text holding an underscore
    or a d/f letter (short-circuit), so plain numbers pay one search and the cast.
    """
    c = _c(c)
    joined = F.regexp_replace(c, _DIGIT_SEPARATOR, "")
    odd = F.when(~joined.rlike(_JAVA_SUFFIX), joined.try_cast("double"))
    return F.when(c.rlike("[_dDfF]"), odd).otherwise(c.try_cast("double"))


def try_double_pct(c) -> Column:
    """Text such as ``13.5%`` -> 13.5."""
    return try_double(F.replace(_c(c), F.lit("%"), F.lit("")))


def first_int(c) -> Column:
    """First run of digits as int; NULL when there is none."""
    return F.regexp_extract(_c(c), r"\d+", 0).try_cast("int")


def emp_length_years(c) -> Column:
    """``10+ years`` -> 10, ``< 1 year`` -> 0, else the first digits, else NULL."""
    c = _c(c)
    return (F.when(c == "10+ years", F.lit(10))
            .when(c == "< 1 year", F.lit(0))
            .otherwise(first_int(c)))


def month_year_date(c, strict: bool = True) -> Column:
    """``Dec-2015`` -> 2015-12-01; outer spaces ignored, month name in any case,
    a short year read as written (``Dec-15`` -> year 15), as SQL ``strptime``
    with ``%b-%Y`` does.  Strict mode raises on unparsable text."""
    c = F.trim(_c(c))
    parsed = F.try_to_date(c, "MMM-y")
    if not strict:
        return parsed
    # raise whatever the session's ANSI setting (to_date only raises under ANSI)
    bad = F.raise_error(F.concat(F.lit("unparsable month-year text: "), c)).cast("date")
    return F.when(c.isNotNull() & parsed.isNull(), bad).otherwise(parsed)


def calendar_months(start, end) -> Column:
    """Calendar month boundaries crossed from ``start`` to ``end`` (bigint).

    Not Spark's ``months_between``: Jan-31 -> Feb-01 counts 1 here.
    """
    s, e = _c(start), _c(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("bigint")


def ratio(num, den) -> Column:
    """num / den, NULL where den is 0 or NULL (ANSI-safe)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def nan_to_null(c) -> Column:
    """Treat NaN as missing, as pandas comparisons and medians do (double result)."""
    c = _c(c).cast("double")
    return F.when(~F.isnan(c), c)
