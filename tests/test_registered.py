"""Every registered query against its DuckDB twin, and the shape of the registry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check_oracle
from conftest import SF
from fixture import oracle, queries
from fixture import tables as t

VIEWS = [
    "billing_gcp", "billing_gcp_by_project", "billing_gmp", "billing_gmp_by_project", "sum_costs_month",
    "sum_costs_month_by_project", "reseller_view", "reseller_invoice", "cost_by_account", "cost_by_project",
    "support_fee", "billing_adjustments", "statement_lines", "statement_lines_view",
]
BILLING = [*queries.composite(), *queries.single()]
JOBS = [
    "load_maps_services", "load_workspace_sku", "load_sku_third_party", "seed_payer_accounts",
    "seed_currency_symbols", "purge_month",
]


def test_registry_is_complete():
    assert set(VIEWS + JOBS) <= set(BILLING)
    assert set(oracle.composite()) | set(oracle.single()) == set(BILLING)
    assert set(BILLING) <= set(entry.queries()) and set(BILLING) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", BILLING)
def test_query_equals_twin(spark, duck, name):
    assert check_oracle.compare(spark, duck, name, SF).startswith("ok")


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_fixture_is_the_same_row_by_row(spark, duck):
    """The whole export, nested columns as text."""
    shown = """billing_account_id, payer_billing_account_id, invoice.month AS month, service.id AS service_id,
        service.description AS service, sku.id AS sku_id, sku.description AS sku, project.id AS project_id,
        CAST(cost AS DOUBLE) AS cost, CAST(customer_cost AS DOUBLE) AS customer_cost, currency,
        currency_conversion_rate, usage.amount AS usage_amount, usage.unit AS unit, transaction_type, seller_name,
        cost_type, adjustment_info.adjustment_description AS description, adjustment_info.adjustment_type AS kind"""
    df = t.export(spark, SF).selectExpr(
        *[part.strip() for part in shown.split(",")],
        "date_format(export_time, 'yyyy-MM-dd HH:mm:ss') AS exported",
        "date_format(usage_start_time, 'yyyy-MM-dd') AS started",
        "date_format(usage_end_time, 'yyyy-MM-dd') AS ended",
        "array_join(transform(credits, c -> concat(coalesce(c.type, '-'), '=', c.amount)), ';') AS credit_text",
        "array_join(transform(system_labels, l -> concat(l.key, '=', coalesce(l.value, '-'))), ';') AS label_text",
    )
    sql = oracle.with_(
        [oracle.EXPORT],
        f"""SELECT {shown}, strftime(export_time, '%Y-%m-%d %H:%M:%S') AS exported,
        strftime(usage_start_time, '%Y-%m-%d') AS started, strftime(usage_end_time, '%Y-%m-%d') AS ended,
        array_to_string([coalesce(c.type, '-') || '=' || c.amount FOR c IN credits], ';') AS credit_text,
        array_to_string([l.key || '=' || coalesce(l.value, '-') FOR l IN system_labels], ';') AS label_text
        FROM export""",
    )
    cursor = duck.execute(sql)
    names = [c[0] for c in cursor.description]
    assert check_oracle.rows_of(df.columns, df.collect()) == check_oracle.rows_of(names, cursor.fetchall())


