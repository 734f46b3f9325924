"""Dates in clearing records: day-of-year forms, missing years, effective spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date layouts found in the records, as Spark patterns.
COMPACT_PATTERNS = {
    "yyyymmdd": "yyyyMMdd",
    "yymmdd": "yyMMdd",
    "mmddyy": "MMddyy",
    "yyddd": "yyDDD",
    "yyyyddd": "yyyyDDD",
}


def compact_date(c: Column, layout: str) -> Column:
    """Date from digits in one of the known layouts, null when it is not one."""
    return F.try_to_date(c, COMPACT_PATTERNS[layout])


def day_of_year_date(c: Column, reference: Column) -> Column:
    """Last three digits are the day of the year of ``reference``."""
    return F.try_to_date(
        F.concat(F.date_format(reference, "yyyy"), F.right(c, F.lit(3))), "yyyyDDD"
    )


def infer_year_from_month_day(c: Column, reference: Column) -> Column:
    """``MMDD`` in the reference year, or the year before when its month is still to come."""
    month = F.left(c, F.lit(2)).try_cast("int")
    year = F.year(reference) - F.when(month <= F.month(reference), 0).otherwise(1)
    return F.when(c != "0000", F.try_to_date(F.concat(year.cast("string"), c), "yyyyMMdd"))


def infer_year_from_day_of_year(c: Column, reference: Column) -> Column:
    """``..DDD`` in the reference year, or the year before when that day is still to come."""
    day = F.right(c, F.lit(3)).try_cast("int")
    year = F.year(reference) - F.when(day <= F.dayofyear(reference), 0).otherwise(1)
    return F.when(
        c != "0000",
        F.try_to_date(F.concat(year.cast("string"), F.lpad(day.cast("string"), 3, "0")), "yyyyDDD"),
    )


def is_julian_yddd(c: Column, reference: Column) -> Column:
    """True for a year digit and day number valid in the decade of ``reference``."""
    year = F.concat(F.left(F.year(reference).cast("string"), F.lit(3)), F.left(c, F.lit(1)))
    return F.coalesce(
        c.rlike("^[0-9]{4}$")
        & F.try_to_date(F.concat(year, F.right(c, F.lit(3))), "yyyyDDD").isNotNull(),
        F.lit(False),
    )


def in_force(start: Column, end: Column, on: Column) -> Column:
    """``on`` lies in an effective span; an open end reaches up to today."""
    return on.between(start, F.coalesce(end, F.current_date()))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)
