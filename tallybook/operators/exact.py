"""Sums of floating amounts that no order of addition and no partitioning changes.

A floating amount becomes two decimals that can be added without error: the amount to nine places, and what is left of
it to 27. Both are summed on their own and joined only when a sum is shown or asked for zero. An amount is taken as the
shortest decimal number that names it, so 0.1 is a tenth; of 17 digits, all those of amounts of 1e-10 and more count,
and smaller amounts are rounded at the 27th place. NaN and infinite amounts fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StructType

HIGH, LOW = DecimalType(28, 9), DecimalType(28, 27)
#: Wide enough for either part of an amount below ``SMALL``; larger ones have no digits behind the ninth place.
WIDE, SMALL = DecimalType(37, 27), 1e9
#: Types whose sums of two are sums without loss.
ADDED = {"high": DecimalType(37, 9), "low": DecimalType(37, 27)}


def is_floating(kind: DataType) -> bool:
    return isinstance(kind, (DoubleType, FloatType))


def is_split(kind: DataType) -> bool:
    """Whether a column of this type holds amounts in two parts."""
    return isinstance(kind, StructType)


def exact(amount: Column, kind: DataType) -> Column:
    """The amount in a form whose sums are exact: a floating one in two parts, any other as it is."""
    if not is_floating(kind):
        return amount
    amount = amount.cast("string").cast("double") if isinstance(kind, FloatType) else amount
    endless = F.isnan(amount) | (F.abs(amount) == F.lit(float("inf")))
    checked = F.when(endless, F.raise_error(F.lit("an amount is not a number")).cast("double")).otherwise(amount)
    high = checked.cast(HIGH)
    low = F.when(F.abs(amount) < SMALL, (checked.cast(WIDE) - high.cast(WIDE)).cast(LOW)).otherwise(F.lit(0).cast(LOW))
    # an amount that is missing has two missing parts, which sums pass over
    return F.struct(high.alias("high"), F.when(amount.isNotNull(), low).alias("low"))


def summed(amount: Column, split: bool) -> Column:
    """The sum, missing for a group without any amount."""
    if not split:
        return F.sum(amount)
    return F.struct(F.sum(amount["high"]).alias("high"), F.sum(amount["low"]).alias("low"))


def total(amount: Column | str, split: bool = False) -> Column:
    """The sum, zero for a group without any amount."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    if not split:
        return F.coalesce(F.sum(amount), F.lit(0))
    return F.struct(*[F.coalesce(F.sum(amount[part]), F.lit(0).cast(kind)).alias(part) for part, kind in ADDED.items()])


def plus(a: Column, b: Column, split: bool) -> Column:
    if not split:
        return a + b
    return F.struct(*[(a[part].cast(kind) + b[part].cast(kind)).alias(part) for part, kind in ADDED.items()])


def _joined(amount: Column) -> Column:
    return amount["high"].cast(WIDE) + amount["low"].cast(WIDE)


def is_zero(amount: Column, split: bool) -> Column:
    if not split:
        return amount == 0
    small = F.abs(amount["high"]) < F.lit(SMALL).cast("decimal(28,9)")
    return F.when(small, _joined(amount) == 0).otherwise(amount["high"].isNull() & F.lit(None).cast("boolean"))


def shown(amount: Column) -> Column:
    """A sum in two parts as one floating number: the nearest one, below a thousand million in size."""
    small = F.abs(amount["high"]) < F.lit(SMALL).cast("decimal(28,9)")
    return F.when(small, _joined(amount).cast("double")).otherwise(amount["high"].cast("double") + amount["low"].cast("double"))


def as_stored(df: DataFrame, names: list[str], kind: DataType) -> DataFrame:
    """Sums in two parts in the type of the stored amounts; other sums as they are."""
    own = {name: shown(F.col(name)).cast(kind) for name in names if is_split(df.schema[name].dataType)}
    return df.withColumns(own) if own else df
