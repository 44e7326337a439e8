"""Dashboard views: monthly costs beside the contract terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import with_contract

# What the provider charges of each total.
CLOUD_CHARGE = 0.9
MAPS_CHARGE = 0.8


def charge_from_totals(total_gcp, total_gmp):
    return total_gcp * F.lit(CLOUD_CHARGE) + total_gmp * F.lit(MAPS_CHARGE)


def cost_by_account(monthly: DataFrame, contracts: DataFrame) -> DataFrame:
    """Totals per account-month and contract, with the expected provider charge."""
    c = F.col
    rows = with_contract(monthly, contracts).select(
        "billing_account_id",
        "billing_model",
        "cost_gcp",
        "cost_gmp",
        "credits_gcp",
        "credits_gmp",
        c("contract_name").alias("cuenta"),
        c("contract_name").alias("dominio"),
        (c("cost_gcp") + c("credits_gcp")).alias("total_gcp"),
        (c("cost_gmp") + c("credits_gmp")).alias("total_gmp"),
        (c("cost_thirdparty") + c("credits_thirdparty")).alias("total_thirdparty"),
        (c("cost_base_thirdparty") + c("credits_thirdparty")).alias("total_base_thirdparty"),
        (c("cost_thirdparty_marketplace") + c("credits_thirdparty_marketplace")).alias("total_thirdparty_marketplace"),
        "account",
        "reseller_margin_gmp",
        "reseller_margin_gcp",
        "invoice_month",
    )
    return rows.withColumn("cargo_google", charge_from_totals(c("total_gcp"), c("total_gmp")))


def cost_by_project(monthly_by_project: DataFrame, contracts: DataFrame) -> DataFrame:
    """Project costs beside the contract; amounts without a project are the provider's adjustments."""
    return with_contract(monthly_by_project, contracts).select(
        F.col("contract_name").alias("billing_account_desc"),
        F.coalesce("project_id", F.lit("<<<Google Adjustments>>>")).alias("project_id"),
        "billing_model",
        "invoice_month",
        "cost_gcp",
        "credits_gcp",
        "cost_gmp",
        "credits_gmp",
        "reseller_margin_gmp",
        "reseller_margin_gcp",
    )
