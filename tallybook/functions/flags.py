"""Third-party and marketplace flags, and the cost split they drive. All three-valued: NULL is not False."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction types of goods sold for another party.
THIRD_PARTY_TRANSACTIONS = ["THIRD_PARTY_RESELLER", "THIRD_PARTY_AGENCY"]


def is_third_party(listed: Column, transaction_type: Column, seller_name: Column) -> Column:
    """Listed as a third-party SKU, or resold without a named seller."""
    return listed | (transaction_type.isin(THIRD_PARTY_TRANSACTIONS) & seller_name.isNull())


def is_marketplace(transaction_type: Column, seller_name: Column, service: Column) -> Column:
    """Resold with a named seller, except raw compute."""
    return (
        transaction_type.isin(THIRD_PARTY_TRANSACTIONS) & seller_name.isNotNull() & (service != F.lit("Compute Engine"))
    )


def first_party_share(third_party: Column, marketplace: Column, unassigned: Column) -> Column:
    """``unassigned``: no project and no reseller margin in the detail group."""
    return ~(third_party | marketplace | unassigned)


def third_party_share(third_party: Column, marketplace: Column, unassigned: Column) -> Column:
    return third_party | (unassigned & ~marketplace)


def amount_where(condition: Column, amount: Column) -> Column:
    """``amount`` where the condition is true, zero where it is false or NULL."""
    zero = F.lit(0)
    return F.when(condition, F.coalesce(amount, zero)).otherwise(zero)
