"""Exact decimal amounts, their euro value and their text form."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Scale 9 as the statements need; 24 digits and not 38, so that sums and quotients keep all nine decimals.
NUMERIC = DecimalType(24, 9)


def numeric(amount: Column) -> Column:
    return amount.cast(NUMERIC)


def in_euros(amount: Column, rate: Column, *, strict: bool = True) -> Column:
    """Amount divided by the applied rate, at scale 9. A zero rate fails, or gives NULL when not strict."""
    quotient = amount / rate if strict else F.try_divide(amount, rate)
    return quotient.cast(NUMERIC)


def numeric_text(amount: Column) -> Column:
    """Decimal of at most nine places as text without trailing zeros: 12.5, 100, 0.

    A plain cast writes amounts under 1e-6 and zero with an exponent unless the session is ANSI, so only these few go
    through the slower number format.
    """
    wide = amount.cast(DecimalType(38, NUMERIC.scale))
    plain = F.abs(wide) >= F.lit(Decimal("0.000001"))
    text = F.when(plain, wide.cast("string")).otherwise(F.format_number(wide, NUMERIC.scale))
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def with_symbol(symbol: Column, amount: Column) -> Column:
    return F.concat(symbol, numeric_text(amount))
