"""Billing export, lookups and statement tables as DataFrames over the driver's parquet files.

Every rule here has an independent DuckDB twin in ``fixture.oracle``; both follow FIXTURES.md section 2.
Nothing is random and nothing reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.sources import schemas
from tallybook.sources.tables import literal

AS_OF = dt.date(1998, 12, 15)

MONEY = "decimal(18,4)"

SERVICE_NAMES = [
    "Compute Engine",
    "BigQuery",
    "Cloud Storage",
    "Maps JavaScript API",
    "Places API",
    "Geocoding API",
    "Invoice",
    "Reseller Program",
    "Maps Reseller Program",
    "SendGrid",
    "Support",
    "Anthos",
    "Google Workspace",
    "Custom Geo Tiles",
    "Cloud Placement Planner",
    "Cloud maps beta",
    "Marketplace Listing",
    "CLOUD MAPS LEGACY",
    None,
    "Compute Engine",
]
CURRENCIES = ["EUR", "USD", "GBP", "COP"]
RATES = [1.0, 1.25, 0.5, 4000.0]
SECOND_CREDIT_TYPES = [None, "PROMOTION", "RESELLERxMARGIN", "DISCOUNT"]
USAGE_TYPES = [
    "FLEXIBLE_SEATS_ITEM",
    "FLEXIBLE_SEATS_ITEM",
    "COMMITMENT_MONTHLY_ITEM",
    "COMMITMENT_TERM_START_ITEM",
    "COMMITMENT_SEATS_CHANGE_ITEM",
    "OTHER",
]
PAYERS = {f"PAY-{i}": f"Payer {i}" for i in (0, 1, 2, 3, 7)}
SYMBOLS = {"EUR": "€", "USD": "$", "GBP": "£"}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; its schema is read from the file once per session and folder."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _text(prefix: str, value: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), value.cast("string"), F.lit(suffix))


def _quoted(values: list) -> str:
    """A SQL array of these strings or numbers."""
    items = ("NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}D" for v in values)
    return f"array({', '.join(items)})"


def _pick(index: str, values: list) -> str:
    """values[index] for an index known to be in range."""
    return f"{_quoted(values)}[CAST({index} AS INT)]"


ORDER_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "o_orderpriority",
    "CASE WHEN o_custkey % 29 = 0 THEN concat('acct', o_custkey % 8)"
    " ELSE concat('AC-', o_custkey % 8, '-X') END AS billing_account_id",
    "CASE WHEN o_custkey % 8 != 6 THEN concat('PAY-', o_custkey % 8) END AS payer_billing_account_id",
    "concat('proj-', o_custkey % 7) AS order_project",
    _pick("c_nationkey % 4", CURRENCIES) + " AS currency",
    _pick("c_nationkey % 4", RATES) + " AS currency_conversion_rate",
    "CASE o_orderkey % 6 WHEN 3 THEN 'THIRD_PARTY_RESELLER' WHEN 4 THEN 'THIRD_PARTY_AGENCY' WHEN 5 THEN NULL"
    " ELSE 'GOOGLE' END AS transaction_type",
]

LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_returnflag",
    "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
    "CAST(l_discount AS DECIMAL(4,2)) AS discount",
    "CAST(l_tax AS DECIMAL(4,2)) AS tax",
    "CAST(l_shipdate AS TIMESTAMP) AS ship",
]

_CREDITS = f"array<struct<type:string,amount:{MONEY}>>"
_LABELS = "array<struct<key:string,value:string>>"


def _label(key: str, value: str) -> str:
    return f"named_struct('key', '{key}', 'value', {value})"


EXPORT_COLUMNS = [
    "billing_account_id",
    "payer_billing_account_id",
    "named_struct('month', date_format(ship, 'yyyyMM')) AS invoice",
    f"""named_struct('id', concat('SVC-', l_partkey % 20), 'description',
        CASE WHEN o_custkey % 8 = 7 AND month(ship) = 2 THEN 'Reseller Program'
             ELSE {_pick("l_partkey % 20", SERVICE_NAMES)} END) AS service""",
    """named_struct('id', concat('SKU-', l_partkey % 40), 'description',
        CASE WHEN l_partkey % 40 IN (0, 23, 31) THEN 'GCP Partner-led Enhanced Support Variable Fee'
             WHEN l_partkey % 40 != 1 THEN concat('sku ', l_partkey % 40) END) AS sku""",
    "named_struct('id', CASE WHEN l_linenumber != 3 THEN order_project END) AS project",
    f"CAST(CASE WHEN l_quantity = 1 THEN 0 WHEN l_returnflag = 'R' THEN -price ELSE price END AS {MONEY}) AS cost",
    f"CAST(CASE WHEN l_linenumber != 7 THEN price * (1 + tax) END AS {MONEY}) AS customer_cost",
    f"""CASE WHEN l_linenumber = 6 THEN NULL WHEN discount = 0 THEN CAST(array() AS {_CREDITS}) ELSE array(
        named_struct('type', 'RESELLER_MARGIN', 'amount', CAST(-price * discount AS {MONEY})),
        named_struct('type', {_pick("l_orderkey % 4", SECOND_CREDIT_TYPES)},
                     'amount', CAST(-price * tax AS {MONEY}))) END AS credits""",
    "currency",
    "currency_conversion_rate",
    """named_struct('amount', CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END, 'unit', 'seat')
        AS usage""",
    "ship AS usage_start_time",
    "ship + INTERVAL 1 DAY AS usage_end_time",
    "timestamp_seconds(unix_timestamp(ship) + (l_orderkey % 24) * 3600) AS export_time",
    f"""CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 11 = 1 THEN CAST(array() AS {_LABELS}) ELSE array(
        {_label("workspace.googleapis.com/usage_type", _pick("(l_orderkey + l_linenumber) % 6", USAGE_TYPES))},
        {_label("domain_name", "CASE WHEN o_custkey % 8 != 5 THEN concat('d', o_custkey % 8, '.test') END")},
        {_label("workspace.googleapis.com/order_id", "concat('ORD-', o_custkey % 8)")},
        {_label("x/purchase_order_id", "concat('PO-', l_orderkey % 50)")},
        {_label("subscription_id", "concat('SUB-', o_custkey % 50)")},
        {_label("bad/", "'z'")}) END AS system_labels""",
    "transaction_type",
    "seller_name",
    """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'adjustment' WHEN l_linenumber = 2 THEN 'tax'
        ELSE 'regular' END AS cost_type""",
    """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN named_struct('adjustment_description',
        concat('adj ', o_orderpriority), 'adjustment_type', 'GENERAL') END AS adjustment_info""",
    "to_date(ship) AS export_date",
]


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One billing row per order line; ``export_date`` plays the stored partition column.

    Lines and orders are both fact-sized, so they meet in a sort-merge join (which AQE splits when a key is hot); only
    narrow raw columns cross it and the nested ones are built after it. The join with ``part`` named in
    FIXTURES.md is left out: it adds no column and every line has exactly one part.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .selectExpr(*ORDER_COLUMNS)
    )
    seller = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "CASE WHEN s_suppkey % 2 != 0 THEN s_name END AS seller_name"
    )
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(*LINE_COLUMNS)
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(seller, F.col("l_suppkey") == F.col("s_suppkey"))
        .selectExpr(*EXPORT_COLUMNS)
    )


def payer_accounts(spark: SparkSession) -> DataFrame:
    return literal(spark, list(PAYERS.items()), schemas.PAYER_ACCOUNTS)


def maps_services(spark: SparkSession) -> DataFrame:
    return literal(
        spark, [("Custom Geo Tiles",), ("Custom Geo Tiles",), ("Geocoding API",)], schemas.MAPS_SERVICES
    )


def sku_third_party(spark: SparkSession) -> DataFrame:
    return literal(spark, [("SKU-2",), ("SKU-12",), ("SKU-12",), ("SKU-20",)], schemas.THIRD_PARTY_SKUS)


def workspace_skus(spark: SparkSession) -> DataFrame:
    rows = [
        (f"SKU-{i}", f"FLEX-{i}", None if i % 2 == 0 else f"MONTH-{i}", f"SVC-{i % 20}", f"service {i}", f"sku {i}")
        for i in range(0, 40, 3)
    ]
    return literal(spark, rows, schemas.WORKSPACE_SKUS)


def in_doubles(export: DataFrame) -> DataFrame:
    """The export with amounts as doubles, an eighth of the others: more decimals, and no sum that doubles hold exactly."""
    return export.withColumns({
        "cost": F.col("cost").cast("double") / 8,
        "customer_cost": F.col("customer_cost").cast("double") / 8,
        "credits": F.transform(
            "credits", lambda c: F.struct(c["type"].alias("type"), (c["amount"].cast("double") / 8).alias("amount"))
        ),
    })


def in_parts_of_cents(export: DataFrame) -> DataFrame:
    """The export with amounts as doubles, each a part in ten thousand million of the others."""
    tiny = lambda amount: (amount.cast("decimal(18,4)") * F.lit("1e-10").cast("decimal(10,10)")).cast("double")
    return export.withColumns({
        "cost": tiny(F.col("cost")),
        "customer_cost": tiny(F.col("customer_cost")),
        "credits": F.transform("credits", lambda c: F.struct(c["type"].alias("type"), tiny(c["amount"]).alias("amount"))),
    })


def contracts(spark: SparkSession) -> DataFrame:
    terms = [(0, "Flexible"), (0, "Anual"), (1, "Flexible"), (2, "Anual"), (3, "Flexible"), (4, "Anual"), (5, "Flexible")]
    rows = [
        (dt.date(1999, 12, 31), dt.date(1995, 1, 1), f"AC-{i}-X", f"d{i}.test", "true" if i % 2 else "false", model)
        for i, model in terms
    ]
    return literal(spark, rows, schemas.CONTRACTS)


def currency_symbols(spark: SparkSession) -> DataFrame:
    return literal(spark, list(SYMBOLS.items()), schemas.CURRENCY_SYMBOLS)


def sku_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A licence-code sheet with one row per part; some names hold quotes, line breaks or a last backslash."""
    p = F.col("p_partkey")
    end = F.when(p % 7 == 1, F.lit(' 5" x')).when(p % 7 == 2, F.lit("\nnew, line")).when(p % 7 == 3, F.lit("\\")).otherwise(F.lit(""))
    return table(spark, sf_dir, "part").select(
        _text("SKU-", p).alias("sku_id"),
        _text("FLEX-", p).alias("sku_sf_flex"),
        F.when(p % 2 != 0, _text("MONTH-", p)).alias("sku_sf_month"),
        _text("SVC-", p % 20).alias("service_id"),
        F.col("p_type").alias("service_description"),
        F.concat("p_name", end).alias("sku_description"),
    )


def maps_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A maps-service list with one row per part."""
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("sku"))


def third_party_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third-party catalogue with one row per part."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("service_name"),
        F.col("p_name").alias("sku_name"),
        _text("SKU-", p).alias("sku_id"),
        F.when(p % 4 != 0, F.lit("1998-01-01")).alias("date_added"),
    )


def _statement_rows(spark: SparkSession, sf_dir: str, part: int, date_name: str) -> DataFrame:
    """Statement lines of one of the three sources: orders whose key leaves ``part`` modulo 3."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 == part)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    total = F.col("o_totalprice").cast("decimal(12,2)")
    none = k % 10 == 0

    def share(factor: str) -> Column:
        return (total * F.lit(factor).cast("decimal(4,3)")).cast("double")

    third_party = F.when(k % 15 != 0, share("0.125")) if part != 1 else share("0.125")
    columns = {
        "billing_account_id": _text("AC-", c % 8, "-X"),
        "Dominio__c": _text("d", c % 8, ".test"),
        "OpportunityId__c": _text("OPP-", k),
        "SKU__c": (k % 7).cast("double"),
        "CurrencyIsoCode__c": F.expr(_pick("o_custkey % 4", CURRENCIES)),
        "TotalSupport": F.when(k % 20 == 0, share("1")).otherwise(share("0.125")),
        "Margen__c": share("0.125"),
        "Total_gcp": F.when(none, 0.0).otherwise(share("0.5")),
        "Magen_gcp": share("0.125"),
        "Total_gmp": F.when(none, 0.0).otherwise(share("0.25")),
        "Margen_gmp": share("0.125"),
        "Margen_total": share("0.25"),
        "Cargo_Google__c": share("0.5"),
        "Importe__c": share("1"),
        "invoice_month": F.date_format("o_orderdate", "yyyyMM"),
        date_name: F.date_format("o_orderdate", "dd-MM-yyyy"),
        "cambio_aplicado": F.when(k % 50 != 0, F.expr(_pick("o_custkey % 4", RATES))),
        "project_id": F.when(k % 9 != 0, _text("proj-", c % 7)),
        "descripcion": _text("line ", k),
        "Margen_gcp_euros": share("0.125"),
        "Margen_gmp_euros": share("0.125"),
        "Margen_soporte_euros": share("0.25"),
        "Margen_soporte_maps_euros": F.when(k % 4 != 0, share("0.5")),
        "Total_thirdparty": third_party.cast("string") if part == 1 else third_party,
    }
    if part != 2:
        columns["Margen_SWO"] = share("0.25")
    return orders.select(*[value.alias(name) for name, value in columns.items()])


def statements_flexible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statement_rows(spark, sf_dir, 0, "invoce_date")


def statements_by_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statement_rows(spark, sf_dir, 1, "invoice_date")


def statements_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statement_rows(spark, sf_dir, 2, "invoce_date")


def statements_workspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workspace statement lines, one per order (used by the month purge only)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    start = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice").cast("decimal(12,2)") * F.lit("0.5").cast("decimal(4,3)"))
        .cast("double")
        .alias("Cargo_Google__c"),
        _text("licence ", k).alias("Descripcion__c"),
        F.lit("Workspace").alias("Definicion_del_producto__c"),
        start.alias("Fecha_Inicio__c"),
        F.date_add(start, 30).alias("Fecha_Fin__c"),
        _text("d", c % 8, ".test").alias("Dominio__c"),
        F.date_format("o_orderdate", "yyyy").alias("Anyo__c"),
        F.when(k % 40 != 0, F.date_format("o_orderdate", "MM")).alias("Mes__c"),
        F.expr(_pick("o_custkey % 4", CURRENCIES)).alias("CurrencyIsoCode"),
        _text("SKU-", k % 40).alias("SKU2__c"),
        _text("OPP-", k).alias("Oportunidad__c"),
        _text("ORD-", c % 8).alias("Order_Number__c"),
        F.expr(_pick("o_orderkey % 6", USAGE_TYPES)).alias("usage_type"),
        F.lit("flex").alias("type"),
    )
