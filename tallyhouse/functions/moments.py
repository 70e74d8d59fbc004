"""Dates and durations.

Durations subtract two timestamps of the same kind, so the session time zone never plays a part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.schemas import DAYS


def date_key(moment: Column) -> Column:
    """The calendar day as an integer such as 20180131; NULL for NULL."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.day(moment)


def month_label(moment: Column) -> Column:
    """The calendar month as text such as ``2018-01``."""
    return F.date_format(moment, "yyyy-MM")


def started_days(start: Column, end: Column) -> Column:
    """Days from start to end, counted in completed hours (toward zero), two decimals."""
    gap = end - start
    hours = F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)
    return (hours / 24).cast(DAYS)


def floored_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down: five hours early counts as -1."""
    days = F.extract(F.lit("DAY"), end - start)
    reached = start + F.make_dt_interval(days)
    return F.when(end < reached, days - 1).otherwise(days)
