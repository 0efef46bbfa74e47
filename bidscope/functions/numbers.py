"""Rounding and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero (a plain division raises under ANSI rules)."""
    return numerator / F.nullif(denominator, F.lit(0))


def rounded(expression: str, digits: int) -> str:
    """SQL that rounds a double of every row, ties upward.

    ``round`` goes through a decimal object per value, which at one value per auction costs more
    than all the arithmetic around it. The small addend keeps ties that binary doubles hold a
    hair too low on their upper side. ``rint`` stays a double, so NaN and large values stay what
    they are; adding zero turns a negative zero into zero.
    """
    scale = f"1e{digits}"
    return f"(rint(({expression} + 1e-10) * {scale}) / {scale} + 0e0)"


def round_mean(mean: Column, digits: int) -> Column:
    """Round an average of whole or already rounded numbers.

    Such averages often sit on a decimal tie that binary doubles hold a hair too low; the nudge
    puts every tie on the upper side, whatever the order of summation.
    """
    return F.round(mean + F.lit(1e-9), digits)
