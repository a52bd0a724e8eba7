"""Sums of doubles that do not depend on the order of the rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A sum may reach 2**43, and 2**33 values may go into it.
_HIGH = float(2**20)
_MID_BITS = 30
_MID = float(2**_MID_BITS)


def order_free_sum(value: Column) -> Column:
    """The sum of doubles of at least 0, rounded once, whatever the order and the partial sums.

    Whole multiples of 2**-50 are summed as integers, exactly. Only what a value has below them is summed
    in doubles, whose errors lie some fifty bits below the last one of the result.
    """
    scaled = value * F.lit(_HIGH)  # powers of two: these products and differences are exact
    high = F.floor(scaled)
    below = (scaled - high.cast("double")) * F.lit(_MID)
    mid = F.floor(below)
    highs, mids, rest = F.sum(high), F.sum(mid), F.sum(below - mid.cast("double"))
    carried = (highs + F.shiftright(mids, _MID_BITS)).cast("double")
    left = mids.bitwiseAND(F.lit(2**_MID_BITS - 1)).cast("double")
    return carried / F.lit(_HIGH) + (left + rest) / F.lit(_HIGH * _MID)
