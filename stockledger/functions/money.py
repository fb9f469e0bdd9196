"""Money and rounding.

Amounts travel as doubles and are summed exactly, to less than a millionth of
a millionth. Such a sum does not depend on the order of the rows, so a retried
or re-planned stage gives the same cents again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# bits of a limb: 2**37 rows of one group fit a long
LIMB = 26
# binary places that are kept of an addend
PLACES = 40
# doubles from here on are whole numbers
WHOLE = float(1 << 52)
# the highest limb of a larger amount, or the total of many, fits no decimal
LARGEST = 1e22


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact_sum(amount: Column | str) -> Column:
    """Order-independent sum of doubles, as a decimal with twelve places.

    Casting each row to decimal costs about twenty times a plain sum. Instead
    an amount is cut into four limbs, which are integers and exact, and only
    their sums become a decimal. A limb has 26 bits, so billions of rows fit,
    whatever their size; what lies below 2**-40 is rounded. An amount that is
    not a number or beyond any money fails the job instead of spoiling a total.
    """
    amount = as_column(amount).cast("double")
    wrong = F.raise_error(F.lit(f"amount is not a number below {LARGEST:.0e}")).cast("double")
    amount = F.when(F.abs(amount) >= LARGEST, wrong).otherwise(amount)
    unit = float(1 << LIMB)
    # towards zero, so that each difference is exact
    top = (amount / unit).cast("long")
    rest = amount - top.cast("double") * unit
    whole = rest.cast("long")
    fraction = (rest - whole.cast("double")) * unit
    upper = fraction.cast("long")
    lower = F.rint((fraction - upper.cast("double")) * float(1 << (PLACES - LIMB)))
    # carry what the lower limbs have gathered into the higher ones; what is kept is never negative
    sums = [F.sum(limb.cast("long")) for limb in (lower, upper, whole, top)]
    bits = [PLACES - LIMB, LIMB, LIMB]
    kept = []
    for k, size in enumerate(bits):
        kept.append(sums[k].bitwiseAND(F.lit((1 << size) - 1)))
        sums[k + 1] = sums[k + 1] + F.shiftright(sums[k], size)
    below = kept[1] * F.lit(1 << (PLACES - LIMB)) + kept[0]
    point = (below.cast("double") / float(1 << PLACES)).cast("decimal(13,12)")
    total = sums[3].cast("decimal(17,0)") * F.lit(1 << LIMB).cast("decimal(8,0)")
    return total + kept[2].cast("decimal(8,0)") + point


def to_cents(amount: Column | str) -> Column:
    """A decimal rounded to two places, as a double.

    What doubles cannot say exactly lies behind the eighth place and is rounded
    off there first, so half a cent is half a cent.
    """
    return F.round(F.round(as_column(amount), 8), 2).cast("double")


def round_half_away(value: Column | str, digits: int = 0) -> Column:
    """Round a double after scaling it in binary, ties away from zero.

    Spark's own ``round`` works on the printed digits, so 0.285 gives 0.29
    there and 0.28 here. Zero always comes back without a sign. A value that
    is whole at that scale, infinite or not a number comes back as it is.
    """
    value = as_column(value).cast("double")
    scale = float(10**digits)
    below = -F.floor(-value * scale + 0.5)
    above = F.floor(value * scale + 0.5)
    rounded = F.when(value < 0, below).otherwise(above) / F.lit(scale)
    return F.when(F.abs(value * scale) < WHOLE, rounded).otherwise(value)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Part as a percentage of whole; null when whole is zero or null."""
    share = F.lit(100.0) * part.cast("double") / F.nullifzero(whole.cast("double"))
    return round_half_away(share, digits)
