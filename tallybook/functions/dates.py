"""Dates built from billing strings, and the rolling window's lower edge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def window_start(as_of: dt.date | None = None) -> Column:
    """First day of the month three months before ``as_of`` (default: today), as a foldable date."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.add_months(F.trunc(today, "month"), -3)


def invoice_date(month: Column) -> Column:
    """First day of a ``YYYYMM`` invoice month."""
    return F.to_date(F.concat(month, F.lit("01")), "yyyyMMdd")


def statement_date(text: Column, *, strict: bool = True) -> Column:
    """Date from ``d-M-yyyy`` text, one or two digits. Bad text fails, or gives NULL when not strict."""
    return F.to_date(text, "d-M-yyyy") if strict else F.try_to_date(text, "d-M-yyyy")
