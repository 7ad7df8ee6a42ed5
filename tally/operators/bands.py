"""Band joins: rows of one key whose days lie within a band of each other.

An equi-join on the key alone compares all rows of a customer with each other,
and sends a hot customer to one task.  Here days are cut into bins as wide as
the band, one side goes to the two bins it can reach, and rows meet on (key,
bin): a customer spreads over the calendar, and only rows at most two bins
apart are compared, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(c: str) -> Column:
    return F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))


def _bin(day: Column, width: int) -> Column:
    return F.call_function("div", day - F.pmod(day, F.lit(width)), F.lit(width))


def within_days(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                least: int, most: int, out: str = "days_apart") -> DataFrame:
    """Every pair of rows with equal ``key`` and ``least <= right_day - left_day <=
    most`` days, with that difference as ``out``.

    ``right`` is the side that is sent to two bins, so give the smaller one
    there.  Each pair meets in one bin, so none comes twice; equal rows pair as
    often as they are.  NULL keys and days match nothing.  Columns of the two
    sides other than the key must differ in name.
    """
    if least > most:
        return left.join(right, key).where("false").withColumn(out, F.lit(0))
    width = most - least + 1
    a = left.where(F.col(left_day).isNotNull()).withColumn("_bin", _bin(_day(left_day), width))
    first = _bin(_day(right_day) - F.lit(most), width)
    b = right.where(F.col(right_day).isNotNull()).withColumn("_bin", F.explode(F.array(first, first + 1)))
    apart = _day(right_day) - _day(left_day)
    return a.join(b, [key, "_bin"]).where(apart.between(least, most)).withColumn(out, apart).drop("_bin")
