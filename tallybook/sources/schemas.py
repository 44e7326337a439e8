"""Schemas of the billing export, the lookups and the statement tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, DOUBLE, DATE, TIMESTAMP = StringType(), DoubleType(), DateType(), TimestampType()


def _fields(kind: DataType, *names: str) -> list[StructField]:
    return [StructField(name, kind) for name in names]


def _required(name: str, comment: str | None = None) -> StructField:
    return StructField(name, STRING, nullable=False, metadata={"comment": comment} if comment else {})


def export_schema(money: DataType = DOUBLE) -> StructType:
    """The export columns the views read. Amounts have the type the export stores (double, or a decimal)."""
    return StructType(
        _fields(STRING, "billing_account_id", "payer_billing_account_id")
        + [
            StructField("invoice", StructType(_fields(STRING, "month"))),
            StructField("service", StructType(_fields(STRING, "id", "description"))),
            StructField("sku", StructType(_fields(STRING, "id", "description"))),
            StructField("project", StructType(_fields(STRING, "id"))),
        ]
        + _fields(money, "cost", "customer_cost")
        + [
            StructField("credits", ArrayType(StructType(_fields(STRING, "type") + _fields(money, "amount")))),
            StructField("currency", STRING),
            StructField("currency_conversion_rate", DOUBLE),
            StructField("usage", StructType(_fields(DOUBLE, "amount") + _fields(STRING, "unit"))),
        ]
        + _fields(TIMESTAMP, "usage_start_time", "usage_end_time", "export_time")
        + [StructField("system_labels", ArrayType(StructType(_fields(STRING, "key", "value"))))]
        + _fields(STRING, "transaction_type", "seller_name", "cost_type")
        + [StructField("adjustment_info", StructType(_fields(STRING, "adjustment_description", "adjustment_type")))]
    )


WORKSPACE_SKUS = StructType(
    _fields(
        STRING, "sku_id", "sku_sf_flex", "sku_sf_month", "service_id", "service_description", "sku_description"
    )
)
MAPS_SERVICES = StructType(_fields(STRING, "sku"))
THIRD_PARTY_SKUS = StructType(_fields(STRING, "sku_id"))
THIRD_PARTY_CATALOGUE = StructType(_fields(STRING, "service_name", "sku_name", "sku_id", "date_added"))
ACCOUNT_NAMES = StructType(_fields(STRING, "displayName", "ID"))
PAYER_ACCOUNTS = StructType(
    [
        _required("payer_billing_account_id", "Paying account id as it appears in the export"),
        _required("account_name", "Business name or label of the account"),
    ]
)
CURRENCY_SYMBOLS = StructType(
    [_required("currency_iso_code", "ISO code of the currency"), _required("symbol", "Symbol to show")]
)
CONTRACTS = StructType(
    _fields(DATE, "Fecha_Fin_Contrato__c", "Fecha_Inicio_Contrato__c")
    + _fields(STRING, "billing_account_id__c", "billing_account_desc__c", "Desglosar_Facturas__c", "Billing_Model__c")
)
CONTRACTS_FULL = StructType(CONTRACTS.fields + [_required("StageName")] + _fields(STRING, "Empresa_IP__c"))


def _statement(date_name: str, tail: list[StructField]) -> StructType:
    return StructType(
        _fields(STRING, "billing_account_id", "Dominio__c", "OpportunityId__c")
        + _fields(DOUBLE, "SKU__c")
        + _fields(STRING, "CurrencyIsoCode__c")
        + _fields(DOUBLE, "TotalSupport", "Margen__c", "Total_gcp", "Magen_gcp", "Total_gmp", "Margen_gmp")
        + _fields(DOUBLE, "Margen_total", "Cargo_Google__c", "Importe__c")
        + _fields(STRING, "invoice_month", date_name)
        + _fields(DOUBLE, "cambio_aplicado")
        + _fields(STRING, "project_id", "descripcion")
        + _fields(DOUBLE, "Margen_gcp_euros", "Margen_gmp_euros", "Margen_soporte_euros", "Margen_soporte_maps_euros")
        + tail
    )


STATEMENTS_FLEXIBLE = _statement("invoce_date", _fields(DOUBLE, "Margen_SWO", "Total_thirdparty"))
STATEMENTS_BY_PROJECT = _statement("invoice_date", _fields(DOUBLE, "Margen_SWO") + [_required("Total_thirdparty")])
STATEMENTS_ANNUAL = _statement("invoce_date", _fields(DOUBLE, "Total_thirdparty"))
STATEMENTS_WORKSPACE = StructType(
    _fields(DOUBLE, "Cargo_Google__c")
    + _fields(STRING, "Descripcion__c", "Definicion_del_producto__c")
    + _fields(DATE, "Fecha_Inicio__c", "Fecha_Fin__c")
    + _fields(STRING, "Dominio__c", "Anyo__c", "Mes__c", "CurrencyIsoCode", "SKU2__c", "Oportunidad__c")
    + _fields(STRING, "Order_Number__c", "usage_type", "type")
)

TABLES = {
    "reseller_billing_detailed_export_v1": export_schema(),
    "payer_billing_accounts": PAYER_ACCOUNTS,
    "currency_symbols": CURRENCY_SYMBOLS,
    "maps_services": MAPS_SERVICES,
    "ext_maps_services": MAPS_SERVICES,
    "gcp_billing_maps_sku": MAPS_SERVICES,
    "gcp_billing_accounts_name_id": ACCOUNT_NAMES,
    "sku_third_party": THIRD_PARTY_SKUS,
    "workspace_sku_sf": WORKSPACE_SKUS,
    "ext_workspace_sku_sf": WORKSPACE_SKUS,
    "billing_accounts": CONTRACTS,
    "billing_accounts_full": CONTRACTS_FULL,
    "importes_lecturas_temp": STATEMENTS_FLEXIBLE,
    "importes_lecturas_by_project": STATEMENTS_BY_PROJECT,
    "importes_lecturas_anuales": STATEMENTS_ANNUAL,
    "importes_lecturas_workspace": STATEMENTS_WORKSPACE,
    "third_party.sku_third_party": THIRD_PARTY_CATALOGUE,
}
