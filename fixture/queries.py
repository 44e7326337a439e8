"""Every registered query: (session, table folder) -> DataFrame, ready for comparison with its twin."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from tallybook.functions.dates import invoice_date, statement_date
from tallybook.functions.flags import first_party_share, is_marketplace, is_third_party, third_party_share
from tallybook.functions.money import with_symbol
from tallybook.functions.services import CLOUD_EXCLUDED, is_maps_service, is_support_fee
from tallybook.functions.labels import label_value
from tallybook.operators.attributes import with_attributes
from tallybook.operators.charges import charge_lines, flat, total
from tallybook.operators.filters import account_format, rolling_months
from tallybook.operators.lookups import (
    with_contract,
    with_currency_symbol,
    with_maps_listing,
    with_payer_label,
    with_third_party_listing,
    with_workspace_sku,
    without_maps_listing,
)
from tallybook.plans import accounts, costs, invoice, jobs, statements, workspace
from tallybook.session import SETTINGS, fresh_folder
from tallybook.sources import schemas
from tallybook.sources.tables import empty, publish, read_sheet_csv

from . import tables as t

Query = Callable[[SparkSession, str], DataFrame]


def presented(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines hand over the same values."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _registered(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        return presented(build(spark, sf_dir))

    return run


def view_queries(export: Query) -> dict[str, Query]:
    """The view queries over the given source of the billing export."""

    def cost(plan, **options) -> Query:
        return lambda s, d: plan(
            export(s, d), t.sku_third_party(s), t.maps_services(s), t.payer_accounts(s), t.AS_OF, **options
        )

    def maps(s: SparkSession, d: str, **options) -> DataFrame:
        return costs.gmp_costs(export(s, d), t.maps_services(s), t.payer_accounts(s), t.AS_OF, **options)

    cloud, cloud_project = cost(costs.gcp_costs), cost(costs.gcp_costs_by_project)
    monthly, by_project = cost(costs.monthly_costs_one_scan), cost(costs.monthly_costs_by_project_one_scan)

    def statement(plan) -> Query:
        return lambda s, d: plan(
            t.statements_flexible(s, d), t.statements_by_project(s, d), t.statements_annual(s, d), t.currency_symbols(s)
        )

    return {
        "billing_gcp": cloud,
        "billing_gcp_double": lambda s, d: costs.gcp_costs(
            t.in_doubles(export(s, d)), t.sku_third_party(s), t.maps_services(s), t.payer_accounts(s), t.AS_OF
        ),
        "billing_gcp_tiny": lambda s, d: costs.gcp_costs(
            t.in_parts_of_cents(export(s, d)), t.sku_third_party(s), t.maps_services(s), t.payer_accounts(s), t.AS_OF
        ),
        "billing_gcp_by_project": cloud_project,
        "billing_gmp": maps,
        "billing_gmp_by_project": cost(costs.gmp_costs_by_project),
        "billing_gmp_by_project_maps": cost(costs.gmp_costs_by_project, parity=False),
        "sum_costs_month": monthly,
        "sum_costs_month_two_scans": lambda s, d: costs.monthly_costs(maps(s, d), cloud(s, d)),
        "sum_costs_month_by_project": by_project,
        "sum_costs_month_by_project_two_scans": lambda s, d: costs.monthly_costs_by_project(
            cost(costs.gmp_costs_by_project)(s, d), cloud_project(s, d)
        ),
        "sum_costs_month_by_project_maps": cost(costs.monthly_costs_by_project_one_scan, parity=False),
        "reseller_view": lambda s, d: workspace.workspace_charges(
            export(s, d), t.workspace_skus(s), t.AS_OF, stage=workspace.written_once
        ),
        "reseller_view_unstaged": lambda s, d: workspace.workspace_charges(export(s, d), t.workspace_skus(s), t.AS_OF),
        "reseller_invoice": lambda s, d: invoice.reseller_invoice(export(s, d), t.payer_accounts(s)),
        "cost_by_account": lambda s, d: accounts.cost_by_account(monthly(s, d), t.contracts(s)),
        "cost_by_project": lambda s, d: accounts.cost_by_project(by_project(s, d), t.contracts(s)),
        "support_fee": lambda s, d: invoice.support_fee(export(s, d), t.contracts(s), t.payer_accounts(s), t.AS_OF),
        "billing_adjustments": lambda s, d: invoice.billing_adjustments(export(s, d), t.payer_accounts(s)),
        "statement_lines": statement(statements.statement_lines),
        "statement_lines_view": statement(statements.statement_lines_v2),
    }


def composite() -> dict[str, Query]:
    return {name: _registered(build) for name, build in view_queries(t.export).items()}


def _counted(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"))


def _as_text(flag: Column) -> Column:
    """true, false or unknown."""
    return F.coalesce(flag.cast("string"), F.lit("unknown"))


def scan_export(s: SparkSession, d: str) -> DataFrame:
    """A profile that touches every column of the export."""
    c = F.col
    plain = ["billing_account_id", "payer_billing_account_id", "currency", "transaction_type", "seller_name"]
    nested = ["sku.id", "sku.description", "project.id", "usage.unit", "adjustment_info.adjustment_description"]
    return (
        t.export(s, d)
        .groupBy(c("invoice.month").alias("invoice_month"), c("service.description").alias("service"), "cost_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(name).alias(f"has_{name.replace('.', '_')}") for name in plain + nested],
            F.sum("cost").alias("cost"),
            F.sum("customer_cost").alias("customer_cost"),
            F.sum(F.size("credits")).cast("long").alias("credit_lines"),
            F.count("credits").alias("has_credits"),
            F.sum(F.size("system_labels")).cast("long").alias("labels"),
            F.sum("usage.amount").alias("usage_amount"),
            F.sum("currency_conversion_rate").alias("rates"),
            F.min("export_time").alias("first_export"),
            F.max("usage_end_time").alias("last_usage"),
            F.min("service.id").alias("first_service_id"),
        )
    )


def _sheet_profile(sheet: DataFrame) -> DataFrame:
    return sheet.groupBy("service_id", "service_description").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("sku_sf_month").alias("with_month"),
        F.min("sku_id").alias("first_sku"),
        F.max("sku_description").alias("last_name"),
    )


def empty_typed(s: SparkSession, d: str) -> DataFrame:
    """The empty relation takes part in a union with all statements and adds its columns, but no row."""
    rows = empty(s, schemas.STATEMENTS_ANNUAL)
    for source in (t.statements_flexible, t.statements_by_project, t.statements_annual):
        rows = rows.unionByName(source(s, d).select("invoice_month", "Importe__c"), allowMissingColumns=True)
    return rows.groupBy("invoice_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("Importe__c").cast("decimal(18,5)")).alias("amount")
    )


def f_support_sku(s: SparkSession, d: str) -> DataFrame:
    rows = flat(t.export(s, d))
    return _counted(rows, F.col("invoice_month"), _as_text(is_support_fee(F.col("sku"))).alias("is_support"))


def flag_third_party(s: SparkSession, d: str) -> DataFrame:
    rows = with_third_party_listing(flat(t.export(s, d)), t.sku_third_party(s), F.col("sku_id"))
    flag = is_third_party(F.col("third_party_listed"), F.col("transaction_type"), F.col("seller_name"))
    return _counted(rows, F.col("sku_id"), F.col("transaction_type"), _as_text(flag).alias("is_third_party"))


def flag_marketplace(s: SparkSession, d: str) -> DataFrame:
    flag = is_marketplace(F.col("transaction_type"), F.col("seller_name"), F.col("service"))
    return _counted(
        flat(t.export(s, d)), F.col("service"), F.col("transaction_type"), _as_text(flag).alias("is_marketplace")
    )


def _detail(s: SparkSession, d: str) -> DataFrame:
    lookups = (t.sku_third_party(s), t.maps_services(s), t.payer_accounts(s))
    return costs.cloud_detail(t.export(s, d), *lookups, t.AS_OF, exclude=CLOUD_EXCLUDED)


def two_level_costs(s: SparkSession, d: str) -> DataFrame:
    detail = _detail(s, d).drop("is_maps")
    flags = {name: _as_text(F.col(name)) for name in ("is_third_party", "is_marketplace", "project_is_null")}
    return detail.withColumns(flags)


def split_party(s: SparkSession, d: str) -> DataFrame:
    third, market = F.col("is_third_party"), F.col("is_marketplace")
    unassigned = F.col("project_is_null") & (F.col("margin") == 0)
    return (
        _detail(s, d)
        .groupBy(
            "invoice_month",
            _as_text(first_party_share(third, market, unassigned)).alias("first_party"),
            _as_text(third_party_share(third, market, unassigned)).alias("third_party"),
            _as_text(market).alias("marketplace"),
        )
        .agg(F.sum("cost").alias("cost"), F.sum("customer_cost").alias("customer_cost"))
    )


def agg_sum_ifnull(s: SparkSession, d: str) -> DataFrame:
    rows = t.export(s, d).select("*", F.col("service.description").alias("name"))
    return rows.groupBy("name", "currency").agg(
        total(F.when(F.col("adjustment_info").isNotNull(), F.col("customer_cost"))).alias("adjusted"),
        total("cost").alias("cost"),
    )


def credits_split(s: SparkSession, d: str) -> DataFrame:
    """The four sums of the credits, over the lines that all views sum, and how many credits each adds."""
    forms = {"margin": "margin", "cost_credit": "credits", "invoice_credit": "invoice_credits", "every": "all_credits"}
    return charge_lines(flat(t.export(s, d))).groupBy("invoice_month", "transaction_type").agg(
        *[F.sum(line).alias(name) for name, line in forms.items()],
        *[F.count(line).alias(f"n_{name}") for name, line in forms.items()],
    )


def f_maps_service(s: SparkSession, d: str) -> DataFrame:
    rows = with_maps_listing(flat(t.export(s, d)), t.maps_services(s))
    return _counted(rows.filter(is_maps_service(F.col("service"), F.col("maps_listed"))), "service", "currency")


def f_not_maps_service(s: SparkSession, d: str) -> DataFrame:
    rows = with_maps_listing(flat(t.export(s, d)), t.maps_services(s))
    return _counted(rows.filter(~is_maps_service(F.col("service"), F.col("maps_listed"))), "service", "currency")


def j_workspace_sku(s: SparkSession, d: str) -> DataFrame:
    return _counted(
        with_workspace_sku(flat(t.export(s, d)), t.workspace_skus(s)), "sku_id", "sku_sf_flex", "sku_sf_month"
    )


def j_contract(s: SparkSession, d: str) -> DataFrame:
    sums = _counted(flat(t.export(s, d)), "billing_account_id", "invoice_month")
    return with_contract(sums, t.contracts(s))


def _all_statements(s: SparkSession, d: str) -> DataFrame:
    sources = (t.statements_flexible(s, d), t.statements_by_project(s, d), t.statements_annual(s, d))
    return statements.statement_union(*sources)


def j_currency_symbol(s: SparkSession, d: str) -> DataFrame:
    rows = with_currency_symbol(_all_statements(s, d), t.currency_symbols(s))
    return rows.groupBy("CurrencyIsoCode__c", "moneda", "invoice_month").agg(F.count(F.lit(1)).alias("n"))


def _licence_rows(s: SparkSession, d: str) -> DataFrame:
    return with_workspace_sku(workspace.licence_rows(t.export(s, d), t.AS_OF), t.workspace_skus(s))


def j_seat_change_exists(s: SparkSession, d: str) -> DataFrame:
    # rows of one type and seat share their fate, so they are summed before the join, from one scan for both its sides
    rows = workspace.licence_rows(t.export(s, d), t.AS_OF)
    rows = workspace.grouped_once(rows, {"n": F.count(F.lit(1)), "google_charge": F.sum("google_charge")})
    kept = workspace.commitment_rows(with_workspace_sku(rows, t.workspace_skus(s)))
    return kept.groupBy("invoice_month", "domain_name", "usage_type").agg(
        F.sum("n").alias("n"), F.sum("google_charge").alias("google_charge")
    )


def j_old_discount(s: SparkSession, d: str) -> DataFrame:
    rows = invoice.reseller_invoice(t.export(s, d), t.payer_accounts(s))
    return rows.select("invoice_month", "account", "descuento_reseller_old")


def label_attributes(s: SparkSession, d: str) -> DataFrame:
    # equal arrays are counted first and read once: the smallest texts need a sort, which then holds no repeats
    rows = t.export(s, d).groupBy("system_labels").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("system_labels", "n", label_value(F.col("system_labels"), "order_id").alias("direct_order_id"))
    rows = with_attributes(rows)
    return rows.groupBy("usage_type", "domain_name", "order_id", "direct_order_id").agg(
        F.sum("n").alias("n"),
        F.min("attributes_json").alias("first_json"),
        F.max("purchase_order_id").alias("last_purchase_order"),
        F.min("subscription_id").alias("first_subscription"),
    )


def invoice_dates(s: SparkSession, d: str) -> DataFrame:
    rows = t.export(s, d).groupBy(F.col("invoice.month").alias("invoice_month")).agg(
        F.min(F.to_date("usage_start_time")).alias("first_day"), F.max(F.to_date("usage_end_time")).alias("last_day")
    )
    days = _all_statements(s, d).groupBy(statement_date(F.col("date_text")).alias("day")).agg(
        F.count(F.lit(1)).alias("statements")
    )
    dated = rows.withColumn("invoice_date", invoice_date(F.col("invoice_month")))
    return dated.join(days, F.col("invoice_date") == F.col("day"), "left").drop("day")


def statement_union_profile(s: SparkSession, d: str) -> DataFrame:
    rows = _all_statements(s, d)
    amounts = ["TotalSupport", "Total_gcp", "Total_thirdparty", "Importe__c", "Margen_soporte_maps_euros"]
    return rows.groupBy("billing_model", "invoice_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("date_text").alias("last_date"),
        *[F.sum(a).cast("decimal(24,5)").alias(a) for a in amounts],
    )


def _statement(plan, s: SparkSession, d: str) -> DataFrame:
    return view_queries(t.export)[plan](s, d)


def statement_strings(s: SparkSession, d: str) -> DataFrame:
    """The display strings of both views; each row of the union stands once in either, so no join is needed."""
    rows = _all_statements(s, d)
    rows = with_currency_symbol(rows, t.currency_symbols(s))
    shown = {"TotalSupport_str": "TotalSupport", "GCP_original_str": "Total_gcp", "Importe_str": "Importe__c",
             "Total_thirdparty_str": "Total_thirdparty", "Cargo_Google_str": "Cargo_Google__c"}
    return rows.select(
        F.col("OpportunityId__c").alias("OpportunityId"),
        *[with_symbol(F.col("moneda"), F.col(amount)).alias(name) for name, amount in shown.items()],
    )


def support_only_flag(s: SparkSession, d: str) -> DataFrame:
    v1 = _statement("statement_lines", s, d).select("billing_model", "invoice_month", "LecturasSoloSoporte", F.lit("v1").alias("view"))
    v2 = _statement("statement_lines_view", s, d).select("billing_model", "invoice_month", "LecturasSoloSoporte", F.lit("v2").alias("view"))
    return v1.unionByName(v2).groupBy("view", "billing_model", "invoice_month").agg(
        F.sum("LecturasSoloSoporte").alias("support_only"), F.count(F.lit(1)).alias("n")
    )


def fx_convert(s: SparkSession, d: str) -> DataFrame:
    amounts = ["TotalSupport_EUR", "GCP_EUR", "GMP_EUR", "Importe_sin_soporte_EUR", "Cargo_Google_EUR", "Importe_EUR"]
    rows = _statement("statement_lines", s, d)
    return rows.groupBy("Currency", "invoice_month").agg(
        *[F.sum(a).cast("decimal(24,4)").alias(a) for a in amounts], F.count("Importe_EUR").alias("converted")
    )


def cargo_google(s: SparkSession, d: str) -> DataFrame:
    return view_queries(t.export)["cost_by_account"](s, d).select(
        "billing_account_id", "billing_model", "invoice_month", "account", "total_gcp", "total_gmp", "cargo_google"
    )


def _copy(source: Callable[[SparkSession, str], DataFrame], profile: Callable[[DataFrame], DataFrame]) -> Query:
    """Publish a source table, copy it over a target twice, and profile the target."""

    def run(s: SparkSession, d: str) -> DataFrame:
        tag = uuid.uuid4().hex
        src, dst = f"copy_source_{tag}", f"copy_target_{tag}"
        jobs.refresh_copy(source(s, d), src)
        jobs.refresh_copy(s.table(src), dst)
        jobs.refresh_copy(s.table(src), dst)
        result = profile(s.table(dst))
        for name in (src, dst):
            s.sql(f"DROP TABLE {name}")
        return result

    return run


def sheet_from_csv(s: SparkSession, d: str) -> DataFrame:
    """A sheet written as spreadsheets do it: by Python's csv module, one file with a header for each partition."""
    path = f"{fresh_folder(s, 'sheet')}.csv"
    names = schemas.WORKSPACE_SKUS.names

    def lines(batches):
        yield pd.DataFrame({"value": [",".join(names)]})
        for batch in batches:
            out = io.StringIO()
            writer = csv.writer(out, lineterminator="\n")
            writer.writerows([None if v is None else str(v) for v in row] for row in batch.itertuples(index=False))
            if len(batch):
                yield pd.DataFrame({"value": [out.getvalue().removesuffix("\n")]})

    t.sku_sheet(s, d).mapInPandas(lines, "value string").write.text(path)
    return read_sheet_csv(s, path, schemas.WORKSPACE_SKUS)


def seed_payer_accounts(s: SparkSession, d: str) -> DataFrame:
    """Load the payer lookup (the second load finds nothing to do) and label the export with it."""
    name = f"payers_{uuid.uuid4().hex}"
    jobs.load_lookup(s, t.PAYERS, schemas.PAYER_ACCOUNTS, name)
    jobs.load_lookup(s, t.PAYERS, schemas.PAYER_ACCOUNTS, name)
    result = _counted(with_payer_label(flat(t.export(s, d)), s.table(name)), "account", "payer_billing_account_id")
    s.sql(f"DROP TABLE {name}")
    return result


def seed_currency_symbols(s: SparkSession, d: str) -> DataFrame:
    """Load the symbol lookup, change it, load it again, and join the statements with it."""
    name = f"symbols_{uuid.uuid4().hex}"
    jobs.load_lookup(s, {"EUR": "?"}, schemas.CURRENCY_SYMBOLS, name)
    jobs.load_lookup(s, t.SYMBOLS, schemas.CURRENCY_SYMBOLS, name)
    rows = with_currency_symbol(_all_statements(s, d), s.table(name))
    result = rows.groupBy("CurrencyIsoCode__c", "moneda").agg(F.count(F.lit(1)).alias("n"))
    s.sql(f"DROP TABLE {name}")
    return result


def purge_month(s: SparkSession, d: str, partitioned: bool = False) -> DataFrame:
    """Publish the four statement tables (partitioned by the month, if asked), purge October 1998 and count the rest."""
    tag = uuid.uuid4().hex
    sources = {
        "temp": t.statements_flexible(s, d),
        "by_project": t.statements_by_project(s, d),
        "annual": t.statements_annual(s, d),
        "workspace": t.statements_workspace(s, d),
    }
    names = {label: f"{label}_{tag}" for label in sources}
    for label, rows in sources.items():
        month = ["Anyo__c", "Mes__c"] if label == "workspace" else ["invoice_month"]
        publish(rows, names[label], partition_by=month if partitioned else ())
    monthly = [names[label] for label in ("temp", "by_project", "annual")]
    jobs.purge_month(s, "1998", "10", monthly=monthly, workspace=names["workspace"])
    counts = []
    for label, name in names.items():
        month = F.concat_ws("", "Anyo__c", "Mes__c") if label == "workspace" else F.col("invoice_month")
        counts.append(
            s.table(name)
            .groupBy(F.lit(label).alias("source"), month.alias("month"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("Cargo_Google__c").cast("decimal(18,5)")).alias("charge"))
        )
    result, folder = reduce(DataFrame.unionByName, counts), fresh_folder(s, "purged")
    result.write.parquet(folder)
    for name in names.values():
        s.sql(f"DROP TABLE {name}")
    return s.read.schema(result.schema).parquet(folder)


def single() -> dict[str, Query]:
    """Single operators, each over the whole tables."""

    def month_counts(rows: DataFrame) -> DataFrame:
        return _counted(rows.select(F.col("invoice.month").alias("invoice_month"), "billing_account_id", "cost"),
                        "invoice_month", "billing_account_id")

    operators: dict[str, Query] = {
        "scan_export": scan_export,
        "scan_sheet_csv": lambda s, d: _sheet_profile(sheet_from_csv(s, d)),
        "empty_typed": empty_typed,
        "f_account_format": lambda s, d: month_counts(account_format(t.export(s, d))),
        "f_rolling_months": lambda s, d: month_counts(rolling_months(t.export(s, d), t.AS_OF)),
        "f_maps_service": f_maps_service,
        "f_not_maps_service": f_not_maps_service,
        "f_support_sku": f_support_sku,
        "flag_third_party": flag_third_party,
        "flag_marketplace": flag_marketplace,
        "split_party": split_party,
        "two_level_costs": two_level_costs,
        "agg_sum_ifnull": agg_sum_ifnull,
        "credits_split": credits_split,
        "j_sku_third_party": lambda s, d: _counted(
            with_third_party_listing(flat(t.export(s, d)), t.sku_third_party(s), F.col("sku_id")),
            "sku_id", "third_party_listed",
        ),
        "j_maps_keep": lambda s, d: _counted(
            with_maps_listing(flat(t.export(s, d)), t.maps_services(s)), "service", "maps_listed"
        ),
        "j_maps_anti": lambda s, d: _counted(
            without_maps_listing(flat(t.export(s, d)), t.maps_services(s)), "service", "invoice_month"
        ),
        "j_payer_label": lambda s, d: _counted(
            with_payer_label(flat(t.export(s, d)), t.payer_accounts(s)), "account", "payer_billing_account_id"
        ),
        "j_workspace_sku": j_workspace_sku,
        "j_contract": j_contract,
        "j_currency_symbol": j_currency_symbol,
        "j_seat_change_exists": j_seat_change_exists,
        "j_old_discount": j_old_discount,
        "flex_seats": lambda s, d: workspace.flexible_seats(_licence_rows(s, d)),
        "label_attributes": label_attributes,
        "invoice_dates": invoice_dates,
        "statement_union": statement_union_profile,
        "statement_strings": statement_strings,
        "support_only_flag": support_only_flag,
        "fx_convert": fx_convert,
        "cargo_google": cargo_google,
        "load_maps_services": _copy(
            t.maps_sheet, lambda df: df.groupBy("sku").agg(F.count(F.lit(1)).alias("n"))
        ),
        "load_workspace_sku": _copy(sheet_from_csv, _sheet_profile),
        "load_sku_third_party": _copy(
            t.third_party_sheet,
            lambda df: df.groupBy("service_name", "date_added").agg(
                F.count(F.lit(1)).alias("n"), F.min("sku_id").alias("first_sku"), F.max("sku_name").alias("last_name")
            ),
        ),
        "seed_payer_accounts": seed_payer_accounts,
        "seed_currency_symbols": seed_currency_symbols,
        "purge_month": purge_month,
        "purge_month_partitioned": lambda s, d: purge_month(s, d, partitioned=True),
    }
    return {name: _registered(build) for name, build in operators.items()}
