"""Dates, ages and intervals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(c: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.to_date(c, pattern)


def birth_window(day: Column, age: Column) -> tuple[Column, Column]:
    """First and last possible birthday of someone of this age at the end of the day."""
    after = F.date_add(day, 1)
    return F.date_add(F.add_months(after, -12 * (age + 1)), 1), F.add_months(after, -12 * age)


def overlap_days(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    """Days that two closed intervals share; 0 or less if none."""
    return F.datediff(F.least(hi_a, hi_b), F.greatest(lo_a, lo_b)) + 1


def share_of_year_left(day: Column) -> Column:
    return F.datediff(F.make_date(F.year(day), F.lit(12), F.lit(31)), day) / F.lit(365)


def five_year_bucket(year: Column, lowest: int = 1920, highest: int = 2020) -> Column:
    return F.least(F.greatest(year - year % 5, F.lit(lowest)), F.lit(highest))
