"""Date helpers with the reference database's calendar rules."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(d) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def month_start(d: _dt.date, months_back: int = 0) -> _dt.date:
    """First day of the month of ``d``, moved ``months_back`` months earlier."""
    y, m = d.year, d.month - months_back
    while m <= 0:
        m += 12
        y -= 1
    return _dt.date(y, m, 1)


def add_months_oracle(d: _dt.date, n: int) -> _dt.date:
    """Driver-side ADD_MONTHS for a literal: month end maps to month end."""
    y, m = divmod(d.month - 1 + n, 12)
    y += d.year
    m += 1
    import calendar
    last = calendar.monthrange(y, m)[1]
    is_last = d.day == calendar.monthrange(d.year, d.month)[1]
    return _dt.date(y, m, last if is_last or d.day > last else d.day)


def add_months_col(c: Column, n) -> Column:
    """Column ADD_MONTHS keeping month ends at month ends (28 Feb + 1 month = 31 Mar)."""
    moved = F.add_months(c, n)
    return F.when(c == F.last_day(c), F.last_day(moved)).otherwise(moved)


def ic_birth_date(ic: Column) -> Column:
    """Birth date encoded in the first six IC digits (YYMMDD, RR century rule).

    Two-digit years 50-99 are 19xx, 00-49 are 20xx. NULL when not a real date.
    """
    yy = F.substring(ic, 1, 2)
    century = F.when(yy.cast("int") >= 50, F.lit("19")).otherwise(F.lit("20"))
    text = F.concat(century, F.substring(ic, 1, 6))
    return F.when(F.substring(ic, 1, 6).rlike("^[0-9]{6}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))
