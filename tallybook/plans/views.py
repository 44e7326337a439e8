"""All views by name, for SQL users."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.schemas import TABLES
from ..sources.tables import REFRESHERS, Tables, session_key
from . import accounts, costs, invoice, statements, workspace


# The names of the views.
VIEWS = [
    "billing_gcp",
    "billing_gcp_by_project",
    "billing_gmp",
    "billing_gmp_by_project",
    "sum_costs_credits_per_month",
    "sum_costs_credits_per_month_by_project",
    "reseller_view",
    "consumos_google_reseller_factura",
    "consumos_por_account",
    "consumos_por_proyecto_new",
    "consumos_support_flex",
    "gcp_billing_adjustment",
    "importes_lecturas",
    "vista_importes_lecturas",
]
Stage = Callable[[DataFrame], DataFrame]


def build_views(tables: Tables, as_of: dt.date | None = None, *, stage: Stage | None = None) -> dict[str, DataFrame]:
    """The fourteen views over the given tables. Nothing runs yet but the size checks of the lookups.

    With ``stage``, such as ``workspace.written_once``, the licence view scans the export once, when it is built.
    """
    read = tables.read
    export, payers = read("reseller_billing_detailed_export_v1"), read("payer_billing_accounts")
    skus, maps, contracts = read("sku_third_party"), read("maps_services"), read("billing_accounts")
    monthly = costs.monthly_costs_one_scan(export, skus, maps, payers, as_of)
    by_project = costs.monthly_costs_by_project_one_scan(export, skus, maps, payers, as_of)
    statement_tables = [
        read("importes_lecturas_temp"),
        read("importes_lecturas_by_project"),
        read("importes_lecturas_anuales"),
        read("currency_symbols"),
    ]
    return {
        "billing_gcp": costs.gcp_costs(export, skus, maps, payers, as_of),
        "billing_gcp_by_project": costs.gcp_costs_by_project(export, skus, maps, payers, as_of),
        "billing_gmp": costs.gmp_costs(export, maps, payers, as_of),
        "billing_gmp_by_project": costs.gmp_costs_by_project(export, skus, maps, payers, as_of),
        "sum_costs_credits_per_month": monthly,
        "sum_costs_credits_per_month_by_project": by_project,
        "reseller_view": workspace.workspace_charges(export, read("workspace_sku_sf"), as_of, stage=stage),
        "consumos_google_reseller_factura": invoice.reseller_invoice(export, payers),
        "consumos_por_account": accounts.cost_by_account(monthly, contracts),
        "consumos_por_proyecto_new": accounts.cost_by_project(by_project, contracts),
        "consumos_support_flex": invoice.support_fee(export, contracts, payers, as_of),
        "gcp_billing_adjustment": invoice.billing_adjustments(export, payers),
        "importes_lecturas": statements.statement_lines(*statement_tables),
        "vista_importes_lecturas": statements.statement_lines_v2(*statement_tables),
    }


def register_views(tables: Tables, as_of: dt.date | None = None, *, stage: Stage | None = None) -> list[str]:
    """Make every view available to ``spark.sql`` under its own name.

    The views follow their tables: whatever this library writes (``publish``, ``store_export``, the jobs) rebuilds
    them, in all sessions of the application that registered them, and after a change from outside ``sources.tables.refresh(spark)`` does.
    """

    def build() -> list[str]:
        for place in map(tables.location, TABLES):
            if "/" not in place and tables.spark.catalog.tableExists(place):
                tables.spark.catalog.refreshTable(place)
        views = build_views(tables, as_of, stage=stage)
        for name, view in views.items():
            view.createOrReplaceTempView(name)
        return list(views)

    names = build()
    REFRESHERS[session_key(tables.spark)] = build
    return names


def unregister_views(tables: Tables) -> None:
    """Drop the views and no longer rebuild them."""
    REFRESHERS.pop(session_key(tables.spark), None)
    for name in VIEWS:
        tables.spark.catalog.dropTempView(name)
