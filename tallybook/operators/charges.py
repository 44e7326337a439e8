"""Flat charge lines of the export and their sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.credits import is_cost_credit, is_invoice_credit, is_margin
from .exact import exact, is_split, total

DIMENSIONS = {
    "billing_account_id": "billing_account_id",
    "payer_billing_account_id": "payer_billing_account_id",
    "invoice_month": "invoice.month",
    "service": "service.description",
    "sku_id": "sku.id",
    "sku": "sku.description",
    "project_id": "project.id",
    "currency": "currency",
    "transaction_type": "transaction_type",
    "seller_name": "seller_name",
}

MEASURES = ["cost", "customer_cost", "credits", "invoice_credits", "all_credits", "margin"]


def flat(export: DataFrame) -> DataFrame:
    """The dimensions as plain columns beside the amounts; unused ones are pruned down to the scan."""
    return export.select(
        *[F.col(path).alias(name) for name, path in DIMENSIONS.items()], "cost", "customer_cost", "credits"
    )


def charge_lines(rows: DataFrame) -> DataFrame:
    """One line per credit, with the row's cost on the first line (and on the only line of a row without credits).

    Every consumer sums the lines, so nothing is counted twice, and the unnesting stays inside the scan stage.
    Floating amounts become exact ones.
    """
    money, paid = rows.schema["cost"].dataType, rows.schema["customer_cost"].dataType
    others = [c for c in rows.columns if c not in ("cost", "customer_cost", "credits")]
    lines = rows.select(*others, "cost", "customer_cost", F.posexplode_outer("credits").alias("_no", "_credit"))
    first = F.coalesce("_no", F.lit(0)) == 0
    kind = F.col("_credit.type")
    amount = exact(F.col("_credit.amount"), rows.schema["credits"].dataType.elementType["amount"].dataType)
    return lines.select(
        *others,
        F.when(first, exact(F.col("cost"), money)).alias("cost"),
        F.when(first, exact(F.col("customer_cost"), paid)).alias("customer_cost"),
        F.when(is_cost_credit(kind), amount).alias("credits"),
        F.when(is_invoice_credit(kind), amount).alias("invoice_credits"),
        amount.alias("all_credits"),
        F.when(is_margin(kind), amount).alias("margin"),
        first.alias("first_line"),
    )


def sum_charges(lines: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums by ``keys``, zero for a group without any amount."""
    return lines.groupBy(*keys).agg(*[total(m, is_split(lines.schema[m].dataType)).alias(m) for m in measures])
