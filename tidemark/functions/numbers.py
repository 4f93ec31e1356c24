"""Rounding for values that are stored or compared, not shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_digits(value: Column, digits: int) -> Column:
    """Nearest multiple of ``10**-digits`` (halves to even), in double arithmetic.

    ``round`` goes through decimal text and takes as long as the features
    themselves on wide tables. The sum with zero turns -0.0 into 0.0.
    """
    factor = F.lit(float(10**digits))
    return F.rint(value * factor) / factor + F.lit(0.0)


# The display locale groups thousands by points and has a decimal comma.
_SHOWN = {",": ".", ".": ","}
SHOWN_DIGITS = 3


def number_text(value: Column) -> Column:
    """A number as the dashboard shows it: grouped, with up to three digits after the comma.

    Halves round away from zero; zeros at the end and a lone comma go; -0 is shown as 0.
    """
    text = F.format_number(F.round(value, SHOWN_DIGITS) + F.lit(0.0), SHOWN_DIGITS)
    shown = F.translate(text, "".join(_SHOWN), "".join(_SHOWN.values()))
    return F.regexp_replace(shown, ",?0+$", "")
