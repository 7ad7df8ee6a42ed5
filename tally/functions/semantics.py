"""Dialect rules of the source analytics as JVM-side Column expressions.

Each helper returns a built-in Spark expression (no Python UDF), so every
rule stays inside whole-stage codegen.  The rules (numbering as in

* M1/M2  integer average and integer division truncate toward zero
* M3     date differences count unit boundaries crossed
* M4     week number with Sunday start and Jan 1 in week 1
* M5     text equality / LIKE ignore case
* M6     list items are compared after trimming
* M8     text concatenation skips NULL parts
* M9     division by zero gives NULL instead of failing (deliberate)
* M13    rounding is half away from zero; done exactly on integers
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# --------------------------------------------------------------------------
# integers (M1, M2, M9)
# --------------------------------------------------------------------------

def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integer division truncating toward zero; NULL on a zero divisor."""
    return F.call_function("div", _c(a), F.nullif(_c(b), F.lit(0)))


def int_avg(x: ColumnOrName) -> Column:
    """AVG over an integer column with an integer result (toward zero).

    Built from two partial-aggregatable aggregates (sum, count), so it is a
    normal map-side-combined aggregate, not a collect.
    """
    x = _c(x)
    return int_div(F.sum(x), F.count(x))


# --------------------------------------------------------------------------
# exact rounding (M13) -- integer arithmetic, so every engine agrees
# --------------------------------------------------------------------------

def round_ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 0) -> Column:
    """round(num / den, digits), half away from zero, computed exactly.

    ``num`` and ``den`` are integer expressions.  The quotient is formed in
    integer arithmetic at the requested scale and only the final value is
    turned into a double, so the result does not depend on summation order
    or on how an engine rounds binary fractions.  ``den = 0`` gives NULL.
    """
    num, den = _c(num).cast("long"), _c(den).cast("long")
    scale = 10 ** digits
    n = num * F.lit(scale)
    q = F.call_function(
        "div", F.abs(n) * 2 + F.abs(den), F.nullif(F.abs(den), F.lit(0)) * 2)
    signed = F.when((n < 0) != (den < 0), -q).otherwise(q)
    return (signed.cast("double") / F.lit(float(scale)))


def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 1) -> Column:
    """100 * part / whole rounded to ``digits`` decimals (exact)."""
    return round_ratio(_c(part) * 100, whole, digits)


def round_half(x: ColumnOrName, digits: int = 0) -> Column:
    """A double rounded to ``digits`` decimals, half away from zero.  From 2^52
    units of the last digit on a double has nothing to round."""
    x, scale = _c(x).cast("double"), float(10 ** digits)
    units = F.abs(x) * F.lit(scale)
    rounded = F.signum(x) * F.floor(units + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(units < F.lit(2.0 ** 52), rounded).otherwise(x)


# Below this a measured value is added as a decimal.
EXACT_BELOW = 1e8


def measured_sum(x: ColumnOrName, times: ColumnOrName | None = None) -> Column:
    """SUM of a measured double (each value ``times`` often) as a double.

    Values below 1e8 are added as decimals with twelve places, which hold every
    value the text columns can spell without an exponent below 1e-12, so the sum
    does not depend on the order of the rows.  Larger values, infinities and NaN
    are added as doubles (their last digits depend on the order) and on top."""
    x = _c(x).cast("double")
    n = F.lit(1) if times is None else _c(times)
    small = F.abs(x) < F.lit(EXACT_BELOW)
    exact = F.sum(F.when(small, x.cast("decimal(20,12)") * n.cast("decimal(17,0)"))).cast("double")
    large = F.sum(F.when(~small, x * n.cast("double")))
    return F.when(large.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + large)


# --------------------------------------------------------------------------
# dates and times
# --------------------------------------------------------------------------

def minutes_crossed(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (00:59 -> 01:00 is 1)."""
    return F.timestamp_diff(
        "MINUTE", F.date_trunc("minute", _c(start)), F.date_trunc("minute", _c(end)))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Day boundaries crossed from ``start`` to ``end`` (signed)."""
    return F.datediff(_c(end), _c(start))


def month_floor(d: ColumnOrName) -> Column:
    """First day of the month of ``d``."""
    return F.trunc(_c(d), "month")


def us_week(d: ColumnOrName) -> Column:
    """Week of year with weeks starting on Sunday and Jan 1 in week 1."""
    d = _c(d)
    return (int_div(F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2, F.lit(7)) + 1).cast("int")


def weekday_name(ts: ColumnOrName) -> Column:
    """English weekday name (Monday ... Sunday)."""
    return F.date_format(_c(ts), "EEEE")


def year_range(col: ColumnOrName, first_year: int | None = None,
               last_year: int | None = None) -> Column:
    """``first_year <= year(col) <= last_year`` written as a date range.

    A plain range on the column (instead of ``year(col)``) can be pushed to
    the parquet scan and prunes date-partitioned sources.
    """
    c = _c(col)
    cond = F.lit(True)
    if first_year is not None:
        cond = cond & (c >= F.lit(f"{first_year:04d}-01-01").cast("date"))
    if last_year is not None:
        cond = cond & (c < F.lit(f"{last_year + 1:04d}-01-01").cast("date"))
    return cond


# --------------------------------------------------------------------------
# text (M5, M6, M8)
# --------------------------------------------------------------------------

def ci_eq(col: ColumnOrName, value: str | Column) -> Column:
    """Case-insensitive equality."""
    return F.lower(_c(col)) == F.lower(_lit(value))


# Equality of the source's texts: case does not count, nor do blanks at the end.
TEXT_COLLATION = "UTF8_LCASE_RTRIM"


def dialect_text(col: ColumnOrName) -> Column:
    """The text under the source's rules (M5): in GROUP BY, DISTINCT, joins and
    ORDER BY, ``'Cheese'``, ``'CHEESE'`` and ``'cheese  '`` are one value.  Spark's collated
    strings do this in the shuffle's hash and in comparisons, so nothing is
    rewritten.  Which of the spellings a group shows is open; ``plain_text`` of it
    is not."""
    return F.collate(_c(col).cast("string"), TEXT_COLLATION)


def plain_text(col: ColumnOrName) -> Column:
    """One spelling of a dialect text: small letters without blanks at the end."""
    return F.lower(F.rtrim(F.collate(_c(col), "UTF8_BINARY")))


def ci_like(col: ColumnOrName, pattern: str) -> Column:
    """Case-insensitive LIKE."""
    return _c(col).ilike(pattern)


def concat_text(*parts: ColumnOrName) -> Column:
    """Concatenate text, treating NULL parts as empty."""
    return F.concat_ws("", *[_c(p).cast("string") for p in parts])
