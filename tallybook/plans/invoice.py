"""Reseller invoice, support fee and adjustment views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.services import PROGRAM_SERVICES, SUPPORT_SKU
from ..operators.charges import charge_lines, flat, sum_charges
from ..operators.exact import as_stored, is_split, plus, summed, total
from ..operators.filters import account_format, exported_since, rolling_months
from ..operators.lookups import small_enough, with_contract, with_payer_label


def _counted(rows: DataFrame) -> DataFrame:
    return charge_lines(rows).withColumn("n", F.col("first_line").cast("int"))


def reseller_invoice(export: DataFrame, payers: DataFrame, *, since: dt.date | None = None) -> DataFrame:
    """Consumption and reseller discount per month and payer label, newest month first.

    The discount comes as program lines (old style) and as margin credits (new style). Both are conditional sums of
    one grouping: a second look-up of the program lines, or a join with them, would scan the whole history again.
    A month and payer with program lines only gives no row. ``since`` limits the otherwise full history.
    """
    (small,) = small_enough(payers.select("payer_billing_account_id", "account_name"))
    rows = account_format(export)
    if since is not None:
        rows = exported_since(rows, F.lit(since))
    rows = flat(rows).filter(F.col("service") != "Invoice")
    rows = rows.withColumn("is_program", F.col("service").isin(PROGRAM_SERVICES))
    measures = ["cost", "all_credits", "invoice_credits", "margin", "n"]
    if small:
        lines = _counted(with_payer_label(rows, payers, small=True))
    else:
        keys = ["invoice_month", "payer_billing_account_id", "is_program"]
        lines = with_payer_label(sum_charges(_counted(rows), keys, measures), payers, small=False)

    program = F.col("is_program")

    split = {m: is_split(lines.schema[m].dataType) for m in measures}

    def regular(name: str):
        return total(F.when(~program, F.col(name)), split[name])

    groups = lines.groupBy("invoice_month", "account").agg(
        regular("cost").alias("cost"),
        regular("all_credits").alias("all_creditos"),
        regular("invoice_credits").alias("creditos"),
        regular("margin").alias("creditos_reseller"),
        total(F.when(program & F.col("invoice_month").isNotNull(), F.col("cost")), split["cost"]).alias("descuento_reseller_old"),
        regular("n").alias("n"),
    )
    shown = (
        groups.filter(F.col("n") > 0)
        .select(
            "invoice_month",
            "account",
            plus(F.col("cost"), F.col("creditos"), split["cost"]).alias("consumo"),
            "cost",
            "all_creditos",
            "creditos",
            "creditos_reseller",
            "descuento_reseller_old",
            F.col("creditos_reseller").alias("descuento_reseller_new"),
            plus(F.col("descuento_reseller_old"), F.col("creditos_reseller"), split["cost"]).alias("descuento_reseller"),
        )
    )
    amounts = [c for c in shown.columns if c not in ("invoice_month", "account")]
    return as_stored(shown, amounts, export.schema["cost"].dataType).orderBy(F.desc("invoice_month"))


def support_fee(
    export: DataFrame, contracts: DataFrame, payers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Enhanced-support fee per account, contract name, month, currency and payer label, by month.

    The fee lines are summed by account and payer before any join, so the joins see one row per group and need no
    broadcast of their own.
    """
    rows = rolling_months(account_format(export), as_of).filter(F.col("sku.description") == SUPPORT_SKU)
    keys = ["billing_account_id", "payer_billing_account_id", "invoice_month", "currency"]
    fees = sum_charges(charge_lines(flat(rows)), keys, ["cost", "margin"])
    fees = with_payer_label(with_contract(fees, contracts), payers)
    sums = fees.groupBy("billing_account_id", "contract_name", "invoice_month", "currency", "account").agg(
        *[summed(F.col(m), is_split(fees.schema[m].dataType)).alias(shown) for m, shown in (("cost", "cost"), ("margin", "reseller_margin_gcp"))]
    )
    sums = as_stored(sums, ["cost", "reseller_margin_gcp"], export.schema["cost"].dataType)
    return sums.select(
        "billing_account_id",
        F.col("contract_name").alias("dominio"),
        "invoice_month",
        F.lit(SUPPORT_SKU).alias("sku"),
        "cost",
        F.lit(0).cast(sums.schema["cost"].dataType).alias("reseller_margin_gmp"),
        "reseller_margin_gcp",
        "currency",
        "account",
    ).orderBy("invoice_month")


def billing_adjustments(export: DataFrame, payers: DataFrame) -> DataFrame:
    """Every adjustment line of the whole history, with its payer label."""
    rows = export.filter(F.col("cost_type") == "adjustment").select(
        F.col("invoice.month").alias("invoice_month"),
        F.col("sku.description").alias("sku"),
        "cost",
        "cost_type",
        F.col("adjustment_info.adjustment_description").alias("adjustment_description"),
        F.col("adjustment_info.adjustment_type").alias("adjustment_type"),
        "payer_billing_account_id",
    )
    (small,) = small_enough(payers.select("payer_billing_account_id", "account_name"))
    return with_payer_label(rows, payers, small=small).drop("payer_billing_account_id")
