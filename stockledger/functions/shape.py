"""Deterministic curves over months."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockledger.functions.money import as_column


def ramp(step: Column | str, steps: int, low: float, high: float) -> Column:
    """Straight line from low at step 0 to high at the last step."""
    slope = (high - low) / max(steps - 1, 1)
    return F.lit(low) + as_column(step) * F.lit(slope)


def seasonal(date: Column | str, swing: float, phase: float) -> Column:
    """Yearly sine around 1, by month number."""
    angle = (F.month(as_column(date)) - 1) / F.lit(12.0) * F.lit(2 * math.pi) + F.lit(phase)
    return F.lit(1.0) + F.lit(swing) * F.sin(angle)
