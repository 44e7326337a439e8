"""Statement lines: three sources in one, exact decimals, euro amounts and display strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import statement_date
from ..functions.money import in_euros, numeric, with_symbol
from ..operators.lookups import small_enough, with_currency_symbol

# The billing model named for each source.
FLEXIBLE = "Flexible"
BY_PROJECT = "Flexibles desglosadas"
ANNUAL = "Anuales"

TEXT = ["billing_account_id", "Dominio__c", "OpportunityId__c", "CurrencyIsoCode__c", "invoice_month", "project_id"]
AMOUNTS = {
    "TotalSupport": "TotalSupport",
    "Margen_soporte_euros": "Margen_soporte_euros",
    "Margen_soporte_maps_euros": "Margen_soporte_maps_euros",
    "Total_gcp": "Total_gcp",
    "Magen_gcp": "Margen_gcp",
    "Total_gmp": "Total_gmp",
    "Margen_gmp": "Margen_gmp",
    "Total_thirdparty": "Total_thirdparty",
    "Margen_total": "Margen_total",
    "Cargo_Google__c": "Cargo_Google__c",
    "Importe__c": "Importe__c",
    "cambio_aplicado": "cambio_aplicado",
}


def statement_union(flexible: DataFrame, by_project: DataFrame, annual: DataFrame) -> DataFrame:
    """The three sources under one set of names, each tagged with its billing model.

    Two sources spell the date column ``invoce_date``; one holds the third-party total as text. Amounts become exact
    decimals here.
    """

    def lines(source: DataFrame, model: str, date_name: str) -> DataFrame:
        return source.select(
            *TEXT,
            "SKU__c",
            *[numeric(F.col(name)).alias(alias) for name, alias in AMOUNTS.items()],
            F.col(date_name).alias("date_text"),
            F.lit(model).alias("billing_model"),
        )

    return (
        lines(flexible, FLEXIBLE, "invoce_date")
        .unionByName(lines(by_project, BY_PROJECT, "invoice_date"))
        .unionByName(lines(annual, ANNUAL, "invoce_date"))
    )


def _prepared(flexible, by_project, annual, symbols: DataFrame, strict: bool) -> DataFrame:
    rows = statement_union(flexible, by_project, annual)
    rows = with_currency_symbol(rows, symbols, small=small_enough(symbols.select("currency_iso_code", "symbol"))[0])
    return rows.withColumn("invoice_date", statement_date(F.col("date_text"), strict=strict))


def statement_lines(
    flexible: DataFrame, by_project: DataFrame, annual: DataFrame, symbols: DataFrame, *, strict: bool = True
) -> DataFrame:
    """First statement view. A missing third-party total leaves the amount without support NULL.

    A zero rate or a malformed date fails the query; with ``strict=False`` it gives NULL.
    """
    c = F.col
    rate, sign = c("cambio_aplicado"), c("moneda")
    without_support = c("Total_gcp") + c("Total_gmp") + c("Total_thirdparty")

    def euros(amount):
        return in_euros(amount, rate, strict=strict)

    return _prepared(flexible, by_project, annual, symbols, strict).select(
        "billing_account_id",
        c("Dominio__c").alias("Dominio"),
        c("OpportunityId__c").alias("OpportunityId"),
        c("SKU__c").alias("SKU"),
        c("CurrencyIsoCode__c").alias("Currency"),
        c("TotalSupport").alias("TotalSupport_original"),
        c("Total_gcp").alias("GCP_original"),
        c("Total_gmp").alias("GMP_original"),
        c("Total_thirdparty").alias("ThirdParty_original"),
        without_support.alias("Importe_sin_soporte_original"),
        c("Margen_gcp").alias("Margen_GCP"),
        c("Margen_gmp").alias("Margen_GMP"),
        "Margen_total",
        euros(c("TotalSupport")).alias("TotalSupport_EUR"),
        euros(c("Total_gcp")).alias("GCP_EUR"),
        euros(c("Total_gmp")).alias("GMP_EUR"),
        euros(without_support).alias("Importe_sin_soporte_EUR"),
        c("Cargo_Google__c").alias("Cargo_Google_original"),
        euros(c("Cargo_Google__c")).alias("Cargo_Google_EUR"),
        c("Importe__c").alias("Importe_original"),
        euros(c("Importe__c")).alias("Importe_EUR"),
        "invoice_month",
        "invoice_date",
        "cambio_aplicado",
        with_symbol(sign, c("TotalSupport")).alias("TotalSupport_str"),
        with_symbol(sign, c("Total_gcp")).alias("GCP_original_str"),
        with_symbol(sign, c("Total_gmp")).alias("GMP_original_str"),
        with_symbol(sign, c("Cargo_Google__c")).alias("Cargo_Google_str"),
        with_symbol(sign, c("Importe__c")).alias("Importe_str"),
        "billing_model",
        "project_id",
        F.when(c("Total_gcp") + c("Total_gmp") <= F.lit("0.01").cast("decimal(3,2)"), 1)
        .otherwise(0)
        .alias("LecturasSoloSoporte"),
    )


def statement_lines_v2(
    flexible: DataFrame, by_project: DataFrame, annual: DataFrame, symbols: DataFrame, *, strict: bool = True
) -> DataFrame:
    """Second statement view: support margins and third-party text, and a euro amount without third parties."""
    c = F.col
    rate, sign = c("cambio_aplicado"), c("moneda")

    def euros(amount):
        return in_euros(amount, rate, strict=strict)

    return _prepared(flexible, by_project, annual, symbols, strict).select(
        "billing_account_id",
        "Dominio__c",
        "OpportunityId__c",
        "SKU__c",
        "CurrencyIsoCode__c",
        "TotalSupport",
        "Margen_soporte_euros",
        "Margen_soporte_maps_euros",
        "Total_gcp",
        "Margen_gcp",
        "Total_gmp",
        "Margen_gmp",
        "Total_thirdparty",
        "Margen_total",
        euros(c("Total_gcp")).alias("gcp_euros"),
        euros(c("Total_gmp")).alias("gmp_euros"),
        euros(c("Total_thirdparty")).alias("thirdparty_euros"),
        euros(c("Total_gcp") + c("Total_gmp")).alias("Importe_GCP_Eur"),
        "Cargo_Google__c",
        euros(c("Cargo_Google__c")).alias("Cargo_Google_Eur"),
        "Importe__c",
        euros(c("Importe__c")).alias("Importe_Eur"),
        "invoice_month",
        "invoice_date",
        "cambio_aplicado",
        with_symbol(sign, c("TotalSupport")).alias("TotalSupport_str"),
        with_symbol(sign, c("Total_gcp")).alias("Total_gcp_str"),
        with_symbol(sign, c("Total_gmp")).alias("Total_gmp_str"),
        with_symbol(sign, c("Total_thirdparty")).alias("Total_thirdparty_str"),
        with_symbol(sign, c("Cargo_Google__c")).alias("Cargo_Google_str"),
        with_symbol(sign, c("Importe__c")).alias("Importe_str"),
        "billing_model",
        "project_id",
        F.when(c("TotalSupport") == c("Importe__c"), 1).otherwise(0).alias("LecturasSoloSoporte"),
    )
