"""Tests on one credit; ``operators.charges`` unnests and sums credits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARGIN = "RESELLER_MARGIN"


def is_margin(kind: Column) -> Column:
    return kind == F.lit(MARGIN)


def is_cost_credit(kind: Column) -> Column:
    """The cost views' test. ``_`` is a wildcard here, so RESELLERxMARGIN is neither margin nor credit."""
    return kind.isNull() | ~kind.like(MARGIN)


def is_invoice_credit(kind: Column) -> Column:
    """The reseller invoice's test, by plain inequality."""
    return kind.isNull() | (kind != F.lit(MARGIN))
