"""Exact money rounding.

The reference computes averages and their multiples on exact decimals and rounds half
up. Rounding a double instead gives a different cent whenever the exact value ends in 5
at the third decimal (e.g. 3 x 46.775). These helpers round an exact integer ratio.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c) -> Column:
    """A decimal(.,2) money column as an exact integer number of cents."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * 100).cast("bigint")


def round_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """ROUND(num / den, scale) half away from zero, for integer ``num`` given in units of 10^-scale."""
    n, d = num.cast("bigint"), den.cast("bigint")
    # whole decimals: (2 |n| + d) div 2d stays exact beyond the 53 bits of a double
    twice = F.abs(n).cast("decimal(20,0)") * 2 + d
    whole = F.call_function("div", twice, d.cast("decimal(20,0)") * 2)
    step = Decimal(1).scaleb(-scale)
    signed = F.when(n < 0, -whole).otherwise(whole)
    return F.when(d != 0, (signed.cast("decimal(18,0)") * F.lit(step)).cast(f"decimal(18,{scale})"))
