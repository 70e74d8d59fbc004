"""Means and ratios whose value does not depend on the order rows arrive in.

Money is decimal, so its sums are exact; the only floating-point step is the last division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; NULL when ``whole`` is zero or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mean(value: Column) -> Column:
    """Mean of the non-NULL values of an integer or decimal column; NULL when there are none."""
    return ratio(F.sum(value), F.count(value))
