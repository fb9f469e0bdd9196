"""Column helpers. Each takes and returns columns; none touches data."""

from stockledger.functions.dates import days_between, month_end, month_of, months_from
from stockledger.functions.money import exact_sum, percent, round_half_away, to_cents
from stockledger.functions.shape import ramp, seasonal

__all__ = [
    "days_between",
    "exact_sum",
    "month_end",
    "month_of",
    "months_from",
    "percent",
    "ramp",
    "round_half_away",
    "seasonal",
    "to_cents",
]
