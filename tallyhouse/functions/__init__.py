"""Column helpers: plain expressions that stay inside generated code."""

from tallyhouse.functions.money import mean, ratio
from tallyhouse.functions.moments import (
    date_key,
    floored_days,
    month_label,
    started_days,
)
from tallyhouse.functions.places import distance_km
from tallyhouse.functions.text import blank_to_null, is_blank, says_something

__all__ = [
    "blank_to_null",
    "date_key",
    "distance_km",
    "floored_days",
    "is_blank",
    "mean",
    "month_label",
    "ratio",
    "says_something",
    "started_days",
]
