"""Text and number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that counts as surrounding blank. \s under (?U) is the
# Unicode White_Space set; the four information separators count as well.
BLANK = r"[\s\x1c-\x1f]"


def trimmed(line: Column) -> Column:
    """Surrounding blanks of any kind removed, not only spaces."""
    return F.regexp_replace(line, rf"(?U)^{BLANK}+|{BLANK}+$", "")


def tab_fields(line: Column) -> Column:
    return F.split(trimmed(line), "\t")


def blank_fields(line: Column) -> Column:
    return F.split(trimmed(line), rf"(?U){BLANK}+")


# Places are powers of ten whose odd part has at most 24 bits, which keeps the products exact.
_SPLIT = float(2**27 + 1)


def _scaled(part: Column, places: int) -> Column:
    """``part`` (0 <= part < 1) times ``10 ** places``, rounded to a whole number.

    The exact binary value is rounded, half to even: the product's error is computed exactly
    (Dekker's product) and settles what looks like a tie.
    """
    scale = F.lit(float(10**places))
    product = part * scale
    high = part * _SPLIT - (part * _SPLIT - part)
    error = (high * scale - product) + (part - high) * scale
    whole = F.rint(product)
    over = product - whole
    up = (over == 0.5) & (error > 0)
    down = (over == -0.5) & (error < 0)
    step = F.when(up, F.lit(1)).when(down, F.lit(-1)).otherwise(F.lit(0))
    return whole.cast("bigint") + step


def rounded(score: Column, places: int = 8) -> Column:
    """The double nearest to the score's exact binary value rounded half to even.

    Scores are at least 0. From 2**26 on doubles lie further apart than the eighth place, so a score
    is its own rounding; null and NaN stay.
    """
    whole = F.floor(score)
    value = (whole * (10**places) + _scaled(score - whole, places)) / float(10**places)
    return F.when((score >= 0) & (score < float(2**26)), value).otherwise(score)


def ten_decimals(score: Column) -> Column:
    """The score's exact binary value as text with ten decimals, half to even; null for null."""
    whole = F.floor(score)
    part = _scaled(score - whole, 10)
    carry = F.floor(part / F.lit(10**10))
    return F.concat(
        (whole + carry).cast("string"), F.lit("."),
        F.lpad((part - carry * F.lit(10**10)).cast("string"), 10, "0"),
    )
