"""DuckDB twins: the same tables and results, stated independently as plain SQL over the driver's views."""

from __future__ import annotations

import re

EXPORT = """
export AS (
  SELECT
    CASE WHEN o_custkey % 29 = 0 THEN 'acct' || (o_custkey % 8)
         ELSE 'AC-' || (o_custkey % 8) || '-X' END AS billing_account_id,
    CASE WHEN o_custkey % 8 = 6 THEN NULL ELSE 'PAY-' || (o_custkey % 8) END AS payer_billing_account_id,
    {'month': strftime(l_shipdate, '%Y%m')} AS invoice,
    {'id': 'SVC-' || (l_partkey % 20),
     'description': CASE WHEN o_custkey % 8 = 7 AND month(l_shipdate) = 2 THEN 'Reseller Program'
       ELSE ['Compute Engine', 'BigQuery', 'Cloud Storage', 'Maps JavaScript API', 'Places API', 'Geocoding API',
             'Invoice', 'Reseller Program', 'Maps Reseller Program', 'SendGrid', 'Support', 'Anthos',
             'Google Workspace', 'Custom Geo Tiles', 'Cloud Placement Planner', 'Cloud maps beta',
             'Marketplace Listing', 'CLOUD MAPS LEGACY', NULL, 'Compute Engine'][(l_partkey % 20) + 1] END} AS service,
    {'id': 'SKU-' || (l_partkey % 40),
     'description': CASE WHEN l_partkey % 40 IN (0, 23, 31) THEN 'GCP Partner-led Enhanced Support Variable Fee'
       WHEN l_partkey % 40 = 1 THEN NULL ELSE 'sku ' || (l_partkey % 40) END} AS sku,
    {'id': CASE WHEN l_linenumber = 3 THEN NULL ELSE 'proj-' || (o_custkey % 7) END} AS project,
    CAST(CASE WHEN l_quantity = 1 THEN 0 WHEN l_returnflag = 'R' THEN -price ELSE price END AS DECIMAL(18,4)) AS cost,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(price * (1 + tax) AS DECIMAL(18,4)) END AS customer_cost,
    CASE WHEN l_linenumber = 6 THEN NULL WHEN disc = 0 THEN [] ELSE [
      {'type': 'RESELLER_MARGIN', 'amount': CAST(-price * disc AS DECIMAL(18,4))},
      {'type': [NULL, 'PROMOTION', 'RESELLERxMARGIN', 'DISCOUNT'][(l_orderkey % 4) + 1],
       'amount': CAST(-price * tax AS DECIMAL(18,4))}] END AS credits,
    ['EUR', 'USD', 'GBP', 'COP'][(c_nationkey % 4) + 1] AS currency,
    CAST([1.0, 1.25, 0.5, 4000.0][(c_nationkey % 4) + 1] AS DOUBLE) AS currency_conversion_rate,
    {'amount': CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END, 'unit': 'seat'} AS usage,
    l_shipdate AS usage_start_time,
    l_shipdate + INTERVAL 1 DAY AS usage_end_time,
    l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS export_time,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 11 = 1 THEN [] ELSE [
      {'key': 'workspace.googleapis.com/usage_type',
       'value': ['FLEXIBLE_SEATS_ITEM', 'FLEXIBLE_SEATS_ITEM', 'COMMITMENT_MONTHLY_ITEM', 'COMMITMENT_TERM_START_ITEM',
                 'COMMITMENT_SEATS_CHANGE_ITEM', 'OTHER'][((l_orderkey + l_linenumber) % 6) + 1]},
      {'key': 'domain_name', 'value': CASE WHEN o_custkey % 8 = 5 THEN NULL ELSE 'd' || (o_custkey % 8) || '.test' END},
      {'key': 'workspace.googleapis.com/order_id', 'value': 'ORD-' || (o_custkey % 8)},
      {'key': 'x/purchase_order_id', 'value': 'PO-' || (l_orderkey % 50)},
      {'key': 'subscription_id', 'value': 'SUB-' || (o_custkey % 50)},
      {'key': 'bad/', 'value': 'z'}] END AS system_labels,
    CASE l_orderkey % 6 WHEN 3 THEN 'THIRD_PARTY_RESELLER' WHEN 4 THEN 'THIRD_PARTY_AGENCY' WHEN 5 THEN NULL
         ELSE 'GOOGLE' END AS transaction_type,
    CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE s_name END AS seller_name,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'adjustment' WHEN l_linenumber = 2 THEN 'tax'
         ELSE 'regular' END AS cost_type,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1
         THEN {'adjustment_description': 'adj ' || o_orderpriority, 'adjustment_type': 'GENERAL'} END AS adjustment_info
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS disc,
               CAST(l_tax AS DECIMAL(4,2)) AS tax FROM lineitem) AS l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
)"""

PAYERS = """
payers(payer_id, account_name) AS (
  VALUES ('PAY-0', 'Payer 0'), ('PAY-1', 'Payer 1'), ('PAY-2', 'Payer 2'), ('PAY-3', 'Payer 3'), ('PAY-7', 'Payer 7'))"""

MAPS = """
maps_list(name) AS (VALUES ('Custom Geo Tiles'), ('Custom Geo Tiles'), ('Geocoding API'))"""

SKUS = """
third_skus(id) AS (VALUES ('SKU-2'), ('SKU-12'), ('SKU-12'), ('SKU-20'))"""

LICENCES = """
licences AS (
  SELECT 'SKU-' || i AS id, 'FLEX-' || i AS flex, CASE WHEN i % 2 = 1 THEN 'MONTH-' || i END AS monthly
  FROM range(0, 40, 3) AS r(i))"""

CONTRACTS = """
contracts(account_id, name, model) AS (
  VALUES ('AC-0-X', 'd0.test', 'Flexible'), ('AC-0-X', 'd0.test', 'Anual'), ('AC-1-X', 'd1.test', 'Flexible'),
         ('AC-2-X', 'd2.test', 'Anual'), ('AC-3-X', 'd3.test', 'Flexible'), ('AC-4-X', 'd4.test', 'Anual'),
         ('AC-5-X', 'd5.test', 'Flexible'))"""

SYMBOLS = """
signs(iso, sign) AS (VALUES ('EUR', '€'), ('USD', '$'), ('GBP', '£'))"""

# Lines of the window with a well-formed account, flat, with label, lookups and per-row credit sums.
# The maps services by name.
MAPS_TEST = """(e.service.description IN (
    'Distance Matrix API', 'Street View API', 'Zagat content in the Places API', 'Maps Static API',
    'Places API for iOS', 'Maps Elevation API', 'Maps API', 'Places API for Android', 'Street View Static API',
    'Geocoding API', 'Maps Reseller Program', 'Google Maps Android API', 'Maps and Street View API', 'Directions API',
    'Maps JavaScript API', 'Google Maps SDK for iOS', 'Places API', 'Time Zone API', 'Maps Embed API', 'Roads API',
    'Geolocation API', 'Navigation API', 'Google Maps Platform Rides and Deliveries Service')
  OR contains(e.service.description, 'maps') OR contains(e.service.description, 'Maps')
  OR contains(e.service.description, 'Place') OR m.name IS NOT NULL)"""

CHARGES = f"""
charges AS (
  SELECT e.billing_account_id, e.invoice.month AS invoice_month, e.currency,
    coalesce(p.account_name, 'Unknown') AS account, e.service.description AS service, e.sku.id AS sku_id,
    e.sku.description AS sku, e.project.id AS project_id, e.cost, e.customer_cost,
    list_sum([c.amount FOR c IN e.credits IF c.type = 'RESELLER_MARGIN']) AS margin,
    list_sum([c.amount FOR c IN e.credits IF c.type IS NULL OR c.type NOT LIKE 'RESELLER_MARGIN']) AS credit,
    e.transaction_type IN ('THIRD_PARTY_RESELLER', 'THIRD_PARTY_AGENCY') AS resold,
    e.seller_name IS NOT NULL AS named_seller,
    {MAPS_TEST} AS is_maps
  FROM export AS e
  LEFT JOIN maps_list AS m ON m.name = e.service.description
  LEFT JOIN payers AS p ON p.payer_id = e.payer_billing_account_id
  WHERE e.billing_account_id LIKE '%-%-%' AND e.export_time >= TIMESTAMP '1998-09-01 00:00:00'
)"""

CLOUD = """
cloud AS (
  SELECT c.*, (t.id IS NOT NULL OR (resold AND NOT named_seller)) AS third,
         (resold AND named_seller AND service <> 'Compute Engine') AS market
  FROM charges AS c LEFT JOIN third_skus AS t ON t.id = c.sku_id
  WHERE NOT is_maps AND sku <> 'GCP Partner-led Enhanced Support Variable Fee'
)"""


def detail(name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT billing_account_id, invoice_month, currency, account, service, sku, project_id, third, market,
    coalesce(sum(cost), 0) AS cost, coalesce(sum(customer_cost), 0) AS customer_cost,
    coalesce(sum(credit), 0) AS credit, coalesce(sum(margin), 0) AS margin
  FROM cloud WHERE {where} GROUP BY ALL
)"""


_FIRST = "NOT (third OR market OR (project_id IS NULL AND margin = 0))"
_OTHER = "(third OR (project_id IS NULL AND margin = 0 AND NOT market))"


def _pick(condition: str, amount: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN {amount} ELSE 0 END) AS DOUBLE) AS {name}"


def split(source: str, *, project: bool = False, market: bool = True) -> str:
    """Level-two query over a detail CTE."""
    columns = [
        "CAST(0 AS DOUBLE) AS cost_gmp",
        "CAST(0 AS DOUBLE) AS credits_gmp",
        _pick(_FIRST, "cost", "cost_gcp"),
        _pick(_FIRST, "credit", "credits_gcp"),
        "CAST(0 AS DOUBLE) AS reseller_margin_gmp",
        "CAST(sum(margin) AS DOUBLE) AS reseller_margin_gcp",
        _pick(_OTHER, "customer_cost", "cost_thirdparty"),
        _pick(_OTHER, "cost", "cost_base_thirdparty"),
        _pick(_OTHER, "credit", "credits_thirdparty"),
    ]
    if market:
        columns += [
            _pick("market", "cost", "cost_thirdparty_marketplace"),
            _pick("market", "customer_cost", "customer_cost_thirdparty_marketplace"),
            _pick("market", "credit", "credits_thirdparty_marketplace"),
        ]
    keys = "billing_account_id, invoice_month, currency, account" + (", project_id" if project else "")
    return f"SELECT {keys}, {', '.join(columns)} FROM {source} GROUP BY {keys}"


def maps_costs(*, project: bool = False) -> str:
    keys = "billing_account_id, invoice_month, currency, account" + (", project_id" if project else "")
    return f"""SELECT {keys}, CAST(coalesce(sum(cost), 0) AS DOUBLE) AS cost_gmp,
      CAST(coalesce(sum(credit), 0) AS DOUBLE) AS credits_gmp, CAST(0 AS DOUBLE) AS cost_gcp,
      CAST(0 AS DOUBLE) AS credits_gcp, CAST(coalesce(sum(margin), 0) AS DOUBLE) AS reseller_margin_gmp,
      CAST(0 AS DOUBLE) AS reseller_margin_gcp
    FROM charges
    WHERE is_maps
      AND service NOT IN ('Anthos', 'Invoice', 'Maps Reseller Program', 'Reseller Program', 'Support', 'SendGrid')
    GROUP BY {keys}"""


# Services left out of the account view.
CLOUD_KEPT = "service NOT IN ('Invoice', 'Maps Reseller Program', 'Reseller Program', 'SendGrid')"
COST_TABLES = [EXPORT, PAYERS, MAPS, SKUS, CHARGES, CLOUD]

_BASE = ["cost_gmp", "credits_gmp", "cost_gcp", "credits_gcp", "reseller_margin_gmp", "reseller_margin_gcp"]
_THIRD = ["cost_thirdparty", "cost_base_thirdparty", "credits_thirdparty"]
_MARKET = ["cost_thirdparty_marketplace", "customer_cost_thirdparty_marketplace", "credits_thirdparty_marketplace"]


def combined(left: str, right: str, keys: str, measures: list[str], left_has: list[str]) -> str:
    zeros = ", ".join(f"{m}" if m in left_has else f"CAST(0 AS DOUBLE) AS {m}" for m in measures)
    sums = ", ".join(f"sum({m}) AS {m}" for m in measures)
    return f"""SELECT {keys}, {sums}
    FROM (SELECT {keys}, {zeros} FROM {left} UNION ALL SELECT {keys}, {', '.join(measures)} FROM {right}) AS u
    GROUP BY {keys}"""


def with_(tables: list[str], body: str) -> str:
    return "WITH" + ",".join(tables) + "\n" + body


_GRAIN = "billing_account_id, invoice_month, currency, account"
_MONTHLY_TABLES = [
    *COST_TABLES,
    detail("cloud_detail", CLOUD_KEPT),
    f"\nmaps_side AS ({maps_costs()})",
    f"\ncloud_side AS ({split('cloud_detail')})",
]
_MONTHLY = combined("maps_side", "cloud_side", _GRAIN, _BASE + _THIRD + _MARKET, _BASE)
_PROJECT_TABLES = [
    *COST_TABLES,
    detail("project_detail"),
    f"\nproject_side AS ({split('project_detail', project=True, market=False)})",
]
_PROJECT_GRAIN = _GRAIN + ", project_id"
_MONTHLY_PROJECT = combined("project_side", "project_side", _PROJECT_GRAIN, _BASE + _THIRD, _BASE)
_FIXED_PROJECT_TABLES = [*_PROJECT_TABLES, f"\nmaps_side AS ({maps_costs(project=True)})"]

_BY_ACCOUNT = """SELECT m.billing_account_id, c.model AS billing_model, cost_gcp, cost_gmp, credits_gcp, credits_gmp,
    c.name AS cuenta, c.name AS dominio, exact(cost_gcp + credits_gcp) AS total_gcp,
    exact(cost_gmp + credits_gmp) AS total_gmp, exact(cost_thirdparty + credits_thirdparty) AS total_thirdparty,
    exact(cost_base_thirdparty + credits_thirdparty) AS total_base_thirdparty,
    exact(cost_thirdparty_marketplace + credits_thirdparty_marketplace) AS total_thirdparty_marketplace,
    account, reseller_margin_gmp, reseller_margin_gcp, invoice_month
  FROM monthly AS m LEFT JOIN contracts AS c ON c.account_id = m.billing_account_id"""
# Sums of two amounts with four decimals, kept exact although the amounts are doubles by now.
_BY_ACCOUNT = re.sub(r"exact\(([^)]*)\)", r"CAST(CAST(\1 AS DECIMAL(24,4)) AS DOUBLE)", _BY_ACCOUNT)

INVOICE_LINES = """
invoice_lines AS (
  SELECT e.invoice.month AS invoice_month, coalesce(p.account_name, 'Unknown') AS account,
    e.service.description IN ('Reseller Program', 'Maps Reseller Program') AS program, coalesce(e.cost, 0) AS cost,
    coalesce(list_sum([c.amount FOR c IN e.credits]), 0) AS all_credits,
    coalesce(list_sum([c.amount FOR c IN e.credits IF c.type IS NULL OR c.type <> 'RESELLER_MARGIN']), 0) AS credit,
    coalesce(list_sum([c.amount FOR c IN e.credits IF c.type = 'RESELLER_MARGIN']), 0) AS margin
  FROM export AS e LEFT JOIN payers AS p ON p.payer_id = e.payer_billing_account_id
  WHERE e.billing_account_id LIKE '%-%-%' AND e.service.description <> 'Invoice'
)"""

_INVOICE = """SELECT r.invoice_month, r.account, CAST(r.cost + r.credit AS DOUBLE) AS consumo,
    CAST(r.cost AS DOUBLE) AS cost, CAST(r.all_credits AS DOUBLE) AS all_creditos, CAST(r.credit AS DOUBLE) AS creditos,
    CAST(r.margin AS DOUBLE) AS creditos_reseller, CAST(coalesce(d.cost, 0) AS DOUBLE) AS descuento_reseller_old,
    CAST(r.margin AS DOUBLE) AS descuento_reseller_new,
    CAST(coalesce(d.cost, 0) + r.margin AS DOUBLE) AS descuento_reseller
  FROM (SELECT invoice_month, account, sum(cost) AS cost, sum(all_credits) AS all_credits, sum(credit) AS credit,
          sum(margin) AS margin FROM invoice_lines WHERE NOT program GROUP BY ALL) AS r
  LEFT JOIN (SELECT invoice_month, account, sum(cost) AS cost FROM invoice_lines WHERE program GROUP BY ALL) AS d
    ON d.invoice_month = r.invoice_month AND d.account = r.account"""

_SUPPORT = """SELECT e.billing_account_id, c.name AS dominio, e.invoice.month AS invoice_month,
    'GCP Partner-led Enhanced Support Variable Fee' AS sku, CAST(coalesce(sum(e.cost), 0) AS DOUBLE) AS cost,
    CAST(0 AS DOUBLE) AS reseller_margin_gmp,
    CAST(coalesce(sum(list_sum([x.amount FOR x IN e.credits IF x.type = 'RESELLER_MARGIN'])), 0) AS DOUBLE)
      AS reseller_margin_gcp,
    e.currency, coalesce(p.account_name, 'Unknown') AS account
  FROM export AS e LEFT JOIN contracts AS c ON c.account_id = e.billing_account_id
  LEFT JOIN payers AS p ON p.payer_id = e.payer_billing_account_id
  WHERE e.billing_account_id LIKE '%-%-%' AND e.export_time >= TIMESTAMP '1998-09-01 00:00:00'
    AND e.sku.description = 'GCP Partner-led Enhanced Support Variable Fee'
  GROUP BY ALL"""

_ADJUSTMENTS = """SELECT e.invoice.month AS invoice_month, e.sku.description AS sku, CAST(e.cost AS DOUBLE) AS cost,
    e.cost_type, e.adjustment_info.adjustment_description AS adjustment_description,
    e.adjustment_info.adjustment_type AS adjustment_type, coalesce(p.account_name, 'Unknown') AS account
  FROM export AS e LEFT JOIN payers AS p ON p.payer_id = e.payer_billing_account_id WHERE e.cost_type = 'adjustment'"""

LABELLED = """
labelled AS (
  SELECT e.*, '{' || coalesce(array_to_string(list_filter(
      list_transform(e.system_labels, lambda kv: '"' || CASE
        WHEN contains(kv.key, '/') THEN nullif(regexp_extract(kv.key, '[^/]*$'), '') ELSE kv.key END
        || '": "' || kv.value || '"'), lambda entry: entry IS NOT NULL), ', '), '') || '}' AS attributes_json
  FROM export AS e WHERE e.export_time >= TIMESTAMP '1998-09-01 00:00:00'
)"""

LICENCE_ROWS = """
licence_rows AS (
  SELECT e.*, s.flex, s.monthly, json_extract_string(attributes_json, '$.domain_name') AS domain_name,
    json_extract_string(attributes_json, '$.order_id') AS order_id,
    json_extract_string(attributes_json, '$.purchase_order_id') AS purchase_order_id,
    json_extract_string(attributes_json, '$.subscription_id') AS subscription_id,
    json_extract_string(attributes_json, '$.usage_type') AS usage_type
  FROM labelled AS e LEFT JOIN licences AS s ON s.id = e.sku.id WHERE e.cost <> 0
)"""

SEATS = """
seats AS (
  SELECT billing_account_id, payer_billing_account_id, invoice.month AS invoice_month,
    round(avg(abs(usage.amount))) AS usage_amount, min(usage.unit) AS usage_unit, sum(cost) AS google_charge, currency,
    currency_conversion_rate, service.id AS service_id, service.description AS service_description, sku.id AS sku_id,
    sku.description AS sku_description, min(CAST(usage_start_time AS DATE)) AS usage_start_time,
    max(CAST(usage_end_time AS DATE)) AS usage_end_time, max(export_time) AS export_time, flex AS sku_sf,
    min(attributes_json) AS attributes_json, domain_name, order_id, min(purchase_order_id) AS purchase_order_id,
    min(subscription_id) AS subscription_id, usage_type
  FROM licence_rows WHERE usage_type = 'FLEXIBLE_SEATS_ITEM' GROUP BY ALL
)"""

COMMITTED = """
committed AS (
  SELECT billing_account_id, payer_billing_account_id, invoice.month AS invoice_month, usage.amount AS usage_amount,
    usage.unit AS usage_unit, cost AS google_charge, currency, currency_conversion_rate, service.id AS service_id,
    service.description AS service_description, sku.id AS sku_id, sku.description AS sku_description,
    CAST(usage_start_time AS DATE) AS usage_start_time, CAST(usage_end_time AS DATE) AS usage_end_time, export_time,
    monthly AS sku_sf, attributes_json, domain_name, order_id, purchase_order_id, subscription_id, usage_type
  FROM licence_rows AS r
  WHERE usage_type IN ('COMMITMENT_MONTHLY_ITEM', 'COMMITMENT_TERM_START_ITEM')
     OR (usage_type = 'COMMITMENT_SEATS_CHANGE_ITEM' AND (invoice.month, domain_name, sku.id) IN (
       SELECT (invoice.month, domain_name, sku.id) FROM licence_rows
       WHERE usage_type IN ('COMMITMENT_MONTHLY_ITEM', 'COMMITMENT_TERM_START_ITEM') AND domain_name IS NOT NULL))
)"""


def licence_output(source: str) -> str:
    return f"""SELECT billing_account_id, payer_billing_account_id, invoice_month,
    strftime(strptime(invoice_month || '01', '%Y%m%d'), '%Y-%m-%d') AS invoice_date, usage_amount, usage_unit,
    CAST(google_charge AS DOUBLE) AS google_charge, currency, currency_conversion_rate, service_id, service_description,
    sku_id, sku_description, strftime(usage_start_time, '%Y-%m-%d') AS usage_start_time,
    strftime(usage_end_time, '%Y-%m-%d') AS usage_end_time, strftime(export_time, '%Y-%m-%d %H:%M:%S') AS export_time,
    sku_sf, sku_sf IS NULL AS match_sf, attributes_json, domain_name, order_id, purchase_order_id, subscription_id,
    usage_type FROM {source} WHERE google_charge <> 0"""


_LICENCE_TABLES = [EXPORT, LICENCES, LABELLED, LICENCE_ROWS]


def _source(part: int, model: str) -> str:
    third = "share(0.125)" if part == 1 else "CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE share(0.125) END"
    text = f"""SELECT 'AC-' || (o_custkey % 8) || '-X' AS billing_account_id,
      'd' || (o_custkey % 8) || '.test' AS domain, 'OPP-' || o_orderkey AS opportunity,
      CAST(o_orderkey % 7 AS DOUBLE) AS sku, ['EUR', 'USD', 'GBP', 'COP'][(o_custkey % 4) + 1] AS iso,
      CASE WHEN o_orderkey % 20 = 0 THEN share(1) ELSE share(0.125) END AS support,
      CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE share(0.5) END AS gcp,
      CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE share(0.25) END AS gmp,
      {third} AS third, share(0.125) AS margin_gcp, share(0.125) AS margin_gmp, share(0.25) AS margin_total,
      share(0.25) AS margin_support, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE share(0.5) END AS margin_support_maps,
      share(0.5) AS charge, share(1) AS amount, strftime(o_orderdate, '%Y%m') AS invoice_month,
      strftime(o_orderdate, '%Y-%m-%d') AS invoice_date,
      CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE [1.0, 1.25, 0.5, 4000.0][(o_custkey % 4) + 1] END AS rate,
      CASE WHEN o_orderkey % 50 = 0 THEN NULL
           ELSE [1.00000, 0.80000, 2.00000, 0.00025][(o_custkey % 4) + 1] END AS inverse,
      CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'proj-' || (o_custkey % 7) END AS project_id,
      '{model}' AS billing_model FROM orders WHERE o_orderkey % 3 = {part}"""
    for factor in ("0.125", "0.25", "0.5", "1"):
        text = text.replace(
            f"share({factor})", f"CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST({factor} AS DECIMAL(4,3)) AS DECIMAL(24,9))"
        )
    return text


STATEMENTS = (
    "\nstatements AS ("
    + " UNION ALL ".join(_source(i, m) for i, m in enumerate(["Flexible", "Flexibles desglosadas", "Anuales"]))
    + ")"
)
SIGNED = """
signed AS (SELECT s.*, coalesce(g.sign, '€') AS sign FROM statements AS s LEFT JOIN signs AS g ON g.iso = s.iso)"""


def _d(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def _eur(expression: str, name: str) -> str:
    exact = f"CAST(CAST({expression} AS DECIMAL(18,5)) * CAST(inverse AS DECIMAL(6,5)) AS DECIMAL(24,9))"
    return f"CAST({exact} AS DOUBLE) AS {name}"


def _str(expression: str, name: str) -> str:
    return f"sign || rtrim(rtrim(CAST(CAST({expression} AS DECIMAL(24,9)) AS VARCHAR), '0'), '.') AS {name}"


_V1 = ", ".join(
    [
        "billing_account_id, domain AS Dominio, opportunity AS OpportunityId, sku AS SKU, iso AS Currency",
        _d("support", "TotalSupport_original"),
        _d("gcp", "GCP_original"),
        _d("gmp", "GMP_original"),
        _d("third", "ThirdParty_original"),
        _d("gcp + gmp + third", "Importe_sin_soporte_original"),
        _d("margin_gcp", "Margen_GCP"),
        _d("margin_gmp", "Margen_GMP"),
        _d("margin_total", "Margen_total"),
        _eur("support", "TotalSupport_EUR"),
        _eur("gcp", "GCP_EUR"),
        _eur("gmp", "GMP_EUR"),
        _eur("gcp + gmp + third", "Importe_sin_soporte_EUR"),
        _d("charge", "Cargo_Google_original"),
        _eur("charge", "Cargo_Google_EUR"),
        _d("amount", "Importe_original"),
        _eur("amount", "Importe_EUR"),
        "invoice_month, invoice_date",
        _d("rate", "cambio_aplicado"),
        _str("support", "TotalSupport_str"),
        _str("gcp", "GCP_original_str"),
        _str("gmp", "GMP_original_str"),
        _str("charge", "Cargo_Google_str"),
        _str("amount", "Importe_str"),
        "billing_model, project_id",
        "CASE WHEN gcp + gmp <= 0.01 THEN 1 ELSE 0 END AS LecturasSoloSoporte",
    ]
)
_V2 = ", ".join(
    [
        "billing_account_id, domain AS Dominio__c, opportunity AS OpportunityId__c, sku AS SKU__c",
        "iso AS CurrencyIsoCode__c",
        _d("support", "TotalSupport"),
        _d("margin_support", "Margen_soporte_euros"),
        _d("margin_support_maps", "Margen_soporte_maps_euros"),
        _d("gcp", "Total_gcp"),
        _d("margin_gcp", "Margen_gcp"),
        _d("gmp", "Total_gmp"),
        _d("margin_gmp", "Margen_gmp"),
        _d("third", "Total_thirdparty"),
        _d("margin_total", "Margen_total"),
        _eur("gcp", "gcp_euros"),
        _eur("gmp", "gmp_euros"),
        _eur("third", "thirdparty_euros"),
        _eur("gcp + gmp", "Importe_GCP_Eur"),
        _d("charge", "Cargo_Google__c"),
        _eur("charge", "Cargo_Google_Eur"),
        _d("amount", "Importe__c"),
        _eur("amount", "Importe_Eur"),
        "invoice_month, invoice_date",
        _d("rate", "cambio_aplicado"),
        _str("support", "TotalSupport_str"),
        _str("gcp", "Total_gcp_str"),
        _str("gmp", "Total_gmp_str"),
        _str("third", "Total_thirdparty_str"),
        _str("charge", "Cargo_Google_str"),
        _str("amount", "Importe_str"),
        "billing_model, project_id",
        "CASE WHEN support = amount THEN 1 ELSE 0 END AS LecturasSoloSoporte",
    ]
)
_STATEMENT_TABLES = [SYMBOLS, STATEMENTS, SIGNED]


def _eighth(view: str) -> str:
    """All amounts of a cost view by eight, which doubles hold as exactly as the amounts themselves."""
    amounts = ", ".join(f"{name} / 8 AS {name}" for name in [*_BASE, *_THIRD, *_MARKET])
    return f"SELECT * REPLACE ({amounts}) FROM ({view}) AS v"


def _tiny(view: str) -> str:
    """All amounts of a cost view by ten thousand million, as the decimal numbers that they are."""
    tiny = "CAST(CAST({0} AS DECIMAL(20,4)) * CAST('0.0000000001' AS DECIMAL(10,10)) AS DOUBLE) AS {0}"
    return f"SELECT * REPLACE ({', '.join(map(tiny.format, [*_BASE, *_THIRD, *_MARKET]))}) FROM ({view}) AS v"


def composite() -> dict[str, str]:
    """Twins of the views."""
    return {
        "billing_gcp": with_([*COST_TABLES, detail("d", CLOUD_KEPT)], split("d")),
        "billing_gcp_double": _eighth(with_([*COST_TABLES, detail("d", CLOUD_KEPT)], split("d"))),
        "billing_gcp_tiny": _tiny(with_([*COST_TABLES, detail("d", CLOUD_KEPT)], split("d"))),
        "billing_gcp_by_project": with_([*COST_TABLES, detail("d")], split("d", project=True, market=False)),
        "billing_gmp": with_(COST_TABLES[:3] + [CHARGES], maps_costs()),
        "billing_gmp_by_project": with_([*COST_TABLES, detail("d")], split("d", project=True, market=False)),
        "billing_gmp_by_project_maps": with_(
            COST_TABLES[:3] + [CHARGES, f"\nm AS ({maps_costs(project=True)})"],
            f"SELECT *, {', '.join(f'CAST(0 AS DOUBLE) AS {c}' for c in _THIRD)} FROM m",
        ),
        "sum_costs_month": with_(_MONTHLY_TABLES, _MONTHLY),
        "sum_costs_month_two_scans": with_(_MONTHLY_TABLES, _MONTHLY),
        "sum_costs_month_by_project": with_(_PROJECT_TABLES, _MONTHLY_PROJECT),
        "sum_costs_month_by_project_two_scans": with_(_PROJECT_TABLES, _MONTHLY_PROJECT),
        "sum_costs_month_by_project_maps": with_(
            _FIXED_PROJECT_TABLES, combined("maps_side", "project_side", _PROJECT_GRAIN, _BASE + _THIRD, _BASE)
        ),
        "reseller_view": with_(
            [*_LICENCE_TABLES, SEATS, COMMITTED], licence_output("seats") + " UNION ALL " + licence_output("committed")
        ),
        "reseller_view_unstaged": with_(
            [*_LICENCE_TABLES, SEATS, COMMITTED], licence_output("seats") + " UNION ALL " + licence_output("committed")
        ),
        "reseller_invoice": with_([EXPORT, PAYERS, INVOICE_LINES], _INVOICE),
        "cost_by_account": with_(
            [*_MONTHLY_TABLES, f"\nmonthly AS ({_MONTHLY})", CONTRACTS, f"\nby_account AS ({_BY_ACCOUNT})"],
            "SELECT *, total_gcp * CAST(0.9 AS DOUBLE) + total_gmp * CAST(0.8 AS DOUBLE) AS cargo_google FROM by_account",
        ),
        "cost_by_project": with_(
            [*_PROJECT_TABLES, f"\nmonthly AS ({_MONTHLY_PROJECT})", CONTRACTS],
            """SELECT c.name AS billing_account_desc, coalesce(project_id, '<<<Google Adjustments>>>') AS project_id,
            c.model AS billing_model, invoice_month, cost_gcp, credits_gcp, cost_gmp, credits_gmp, reseller_margin_gmp,
            reseller_margin_gcp FROM monthly AS m LEFT JOIN contracts AS c ON c.account_id = m.billing_account_id""",
        ),
        "support_fee": with_([EXPORT, PAYERS, CONTRACTS], _SUPPORT),
        "billing_adjustments": with_([EXPORT, PAYERS], _ADJUSTMENTS),
        "statement_lines": with_(_STATEMENT_TABLES, f"SELECT {_V1} FROM signed"),
        "statement_lines_view": with_(_STATEMENT_TABLES, f"SELECT {_V2} FROM signed"),
    }


# The export flat, without window or account filter.
FLAT = """
flat AS (
  SELECT billing_account_id, payer_billing_account_id, invoice.month AS invoice_month, service.description AS service,
    sku.id AS sku_id, sku.description AS sku, project.id AS project_id, currency, transaction_type, seller_name, cost
  FROM export)"""


def _text(flag: str) -> str:
    return f"CASE WHEN {flag} THEN 'true' WHEN NOT ({flag}) THEN 'false' ELSE 'unknown' END"


def _counted(keys: str, source: str) -> str:
    """Row count and cost per key; ``keys`` may carry aliases."""
    return f"SELECT {keys}, count(*) AS n, CAST(sum(cost) AS DOUBLE) AS cost FROM {source} GROUP BY ALL"


_MAPS_ROWS = MAPS_TEST.replace("e.service.description", "e.service")
_THIRD_FLAG = (
    "(t.id IS NOT NULL OR (transaction_type IN ('THIRD_PARTY_RESELLER', 'THIRD_PARTY_AGENCY') AND seller_name IS NULL))"
)
_MARKET_FLAG = """(transaction_type IN ('THIRD_PARTY_RESELLER', 'THIRD_PARTY_AGENCY') AND seller_name IS NOT NULL
  AND service <> 'Compute Engine')"""
_LABEL_TEXT = LABELLED.replace("WHERE e.export_time >= TIMESTAMP '1998-09-01 00:00:00'", "")


def _sheet(source: str = "part") -> str:
    return f"""SELECT 'SVC-' || (p_partkey % 20) AS service_id, p_type AS service_description, count(*) AS n,
      count(*) FILTER (p_partkey % 2 = 1) AS with_month, min('SKU-' || p_partkey) AS first_sku, max(p_name || CASE p_partkey % 7 WHEN 1 THEN ' 5" x' WHEN 2 THEN chr(10) || 'new, line' WHEN 3 THEN chr(92) ELSE '' END)
      AS last_name FROM {source} GROUP BY ALL"""


def _left(label: str, part: int) -> str:
    return f"""SELECT '{label}' AS source, strftime(o_orderdate, '%Y%m') AS month, count(*) AS n,
      CAST(sum(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.5 AS DECIMAL(4,3))) AS DOUBLE) AS charge
    FROM orders WHERE o_orderkey % 3 = {part} AND strftime(o_orderdate, '%Y%m') <> '199810' GROUP BY ALL"""


def single() -> dict[str, str]:
    """Twins of the single operators."""
    twins = {
        "scan_export": with_(
            [EXPORT],
            """SELECT invoice.month AS invoice_month, service.description AS service, cost_type, count(*) AS n,
            count(billing_account_id) AS has_billing_account_id,
            count(payer_billing_account_id) AS has_payer_billing_account_id, count(currency) AS has_currency,
            count(transaction_type) AS has_transaction_type, count(seller_name) AS has_seller_name,
            count(sku.id) AS has_sku_id, count(sku.description) AS has_sku_description,
            count(project.id) AS has_project_id, count(usage.unit) AS has_usage_unit,
            count(adjustment_info.adjustment_description) AS has_adjustment_info_adjustment_description,
            CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(customer_cost) AS DOUBLE) AS customer_cost,
            CAST(sum(len(credits)) AS BIGINT) AS credit_lines, count(credits) AS has_credits,
            CAST(sum(len(system_labels)) AS BIGINT) AS labels, sum(usage.amount) AS usage_amount,
            sum(currency_conversion_rate) AS rates, strftime(min(export_time), '%Y-%m-%d %H:%M:%S') AS first_export,
            strftime(max(usage_end_time), '%Y-%m-%d %H:%M:%S') AS last_usage, min(service.id) AS first_service_id
            FROM export GROUP BY ALL""",
        ),
        "scan_sheet_csv": _sheet(),
        "empty_typed": """SELECT strftime(o_orderdate, '%Y%m') AS invoice_month, count(*) AS n,
            CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount
            FROM orders GROUP BY ALL""",
        "f_account_format": with_(
            [EXPORT, FLAT],
            _counted("invoice_month, billing_account_id", "flat WHERE contains(billing_account_id, '-X')"),
        ),
        "f_rolling_months": with_(
            [EXPORT],
            _counted("invoice.month AS invoice_month, billing_account_id", "export WHERE export_time >= '1998-09-01'"),
        ),
        "f_maps_service": with_(
            [EXPORT, FLAT, MAPS],
            _counted("service, currency", f"flat AS e LEFT JOIN maps_list AS m ON m.name = e.service WHERE {_MAPS_ROWS}"),
        ),
        "f_not_maps_service": with_(
            [EXPORT, FLAT, MAPS],
            _counted(
                "service, currency", f"flat AS e LEFT JOIN maps_list AS m ON m.name = e.service WHERE NOT {_MAPS_ROWS}"
            ),
        ),
        "f_support_sku": with_(
            [EXPORT, FLAT],
            _counted(
                "invoice_month, "
                + _text("sku = 'GCP Partner-led Enhanced Support Variable Fee'")
                + " AS is_support",
                "flat",
            ),
        ),
        "flag_third_party": with_(
            [EXPORT, FLAT, SKUS],
            _counted(
                f"sku_id, transaction_type, {_text(_THIRD_FLAG)} AS is_third_party",
                "flat LEFT JOIN third_skus AS t ON t.id = sku_id",
            ),
        ),
        "flag_marketplace": with_(
            [EXPORT, FLAT], _counted(f"service, transaction_type, {_text(_MARKET_FLAG)} AS is_marketplace", "flat")
        ),
        "split_party": with_(
            [*COST_TABLES, detail("d", CLOUD_KEPT)],
            f"""SELECT invoice_month, {_text(_FIRST)} AS first_party, {_text(_OTHER)} AS third_party,
            {_text("market")} AS marketplace, CAST(sum(cost) AS DOUBLE) AS cost,
            CAST(sum(customer_cost) AS DOUBLE) AS customer_cost FROM d GROUP BY ALL""",
        ),
        "two_level_costs": with_(
            [*COST_TABLES, detail("d", CLOUD_KEPT)],
            f"""SELECT billing_account_id, invoice_month, currency, account, {_text("third")} AS is_third_party,
            {_text("market")} AS is_marketplace, {_text("project_id IS NULL")} AS project_is_null,
            CASE WHEN project_id IS NULL THEN service END AS detail_service,
            CASE WHEN project_id IS NULL THEN sku END AS detail_sku, CAST(sum(cost) AS DOUBLE) AS cost,
            CAST(sum(customer_cost) AS DOUBLE) AS customer_cost, CAST(sum(credit) AS DOUBLE) AS credits,
            CAST(sum(margin) AS DOUBLE) AS margin FROM d GROUP BY ALL""",
        ),
        "agg_sum_ifnull": with_(
            [EXPORT],
            """SELECT service.description AS name, currency,
            CAST(coalesce(sum(customer_cost) FILTER (cost_type = 'adjustment'), 0) AS DOUBLE) AS adjusted,
            CAST(coalesce(sum(cost), 0) AS DOUBLE) AS cost FROM export GROUP BY ALL""",
        ),
        "credits_split": with_(
            [
                EXPORT,
                """
per_row AS (SELECT invoice.month AS invoice_month, transaction_type,
  list_sum([c.amount FOR c IN credits IF c.type = 'RESELLER_MARGIN']) AS margin,
  list_sum([c.amount FOR c IN credits IF c.type IS NULL OR NOT c.type LIKE 'RESELLER_MARGIN']) AS cost_credit,
  list_sum([c.amount FOR c IN credits IF c.type IS NULL OR c.type <> 'RESELLER_MARGIN']) AS invoice_credit,
  list_sum([c.amount FOR c IN credits]) AS every,
  len([c.amount FOR c IN credits IF c.type = 'RESELLER_MARGIN' AND c.amount IS NOT NULL]) AS c_margin,
  len([c.amount FOR c IN credits IF (c.type IS NULL OR NOT c.type LIKE 'RESELLER_MARGIN') AND c.amount IS NOT NULL]) AS c_cost_credit,
  len([c.amount FOR c IN credits IF (c.type IS NULL OR c.type <> 'RESELLER_MARGIN') AND c.amount IS NOT NULL]) AS c_invoice_credit,
  len([c.amount FOR c IN credits IF c.amount IS NOT NULL]) AS c_every FROM export)""",
            ],
            "SELECT invoice_month, transaction_type, "
            + ", ".join(
                f"CAST(sum({x}) AS DOUBLE) AS {x}, CAST(coalesce(sum(c_{x}), 0) AS BIGINT) AS n_{x}"
                for x in ("margin", "cost_credit", "invoice_credit", "every")
            )
            + " FROM per_row GROUP BY ALL",
        ),
        "j_sku_third_party": with_(
            [EXPORT, FLAT, SKUS],
            _counted("sku_id, t.id IS NOT NULL AS third_party_listed", "flat LEFT JOIN third_skus AS t ON t.id = sku_id"),
        ),
        "j_maps_keep": with_(
            [EXPORT, FLAT, MAPS],
            _counted("service, m.name IS NOT NULL AS maps_listed", "flat LEFT JOIN maps_list AS m ON m.name = service"),
        ),
        "j_maps_anti": with_(
            [EXPORT, FLAT, MAPS],
            _counted(
                "service, invoice_month", "flat WHERE NOT EXISTS (SELECT 1 FROM maps_list AS m WHERE m.name = service)"
            ),
        ),
        "j_payer_label": with_(
            [EXPORT, FLAT, PAYERS],
            _counted(
                "coalesce(p.account_name, 'Unknown') AS account, payer_billing_account_id",
                "flat LEFT JOIN payers AS p ON p.payer_id = payer_billing_account_id",
            ),
        ),
        "j_workspace_sku": with_(
            [EXPORT, FLAT, LICENCES],
            _counted(
                "sku_id, s.flex AS sku_sf_flex, s.monthly AS sku_sf_month", "flat LEFT JOIN licences AS s ON s.id = sku_id"
            ),
        ),
        "j_contract": with_(
            [EXPORT, FLAT, CONTRACTS, f"\nsums AS ({_counted('billing_account_id, invoice_month', 'flat')})"],
            """SELECT s.*, c.name AS contract_name, c.model AS billing_model
            FROM sums AS s LEFT JOIN contracts AS c ON c.account_id = s.billing_account_id""",
        ),
        "j_currency_symbol": with_(
            _STATEMENT_TABLES,
            """SELECT iso AS CurrencyIsoCode__c, sign AS moneda, invoice_month, count(*) AS n FROM signed
            GROUP BY ALL""",
        ),
        "j_seat_change_exists": with_(
            [*_LICENCE_TABLES, COMMITTED],
            """SELECT invoice_month, domain_name, usage_type, count(*) AS n, CAST(sum(google_charge) AS DOUBLE)
            AS google_charge FROM committed GROUP BY ALL""",
        ),
        "j_old_discount": with_(
            [EXPORT, PAYERS, INVOICE_LINES, f"\ninvoice_view AS ({_INVOICE})"],
            "SELECT invoice_month, account, descuento_reseller_old FROM invoice_view",
        ),
        "flex_seats": with_(
            [*_LICENCE_TABLES, SEATS, f"\nshown AS ({licence_output('seats')})"],
            "SELECT * EXCLUDE (invoice_date, match_sf) FROM shown",
        ),
        "label_attributes": with_(
            [EXPORT, _LABEL_TEXT],
            """SELECT json_extract_string(attributes_json, '$.usage_type') AS usage_type,
            json_extract_string(attributes_json, '$.domain_name') AS domain_name,
            json_extract_string(attributes_json, '$.order_id') AS order_id,
            json_extract_string(attributes_json, '$.order_id') AS direct_order_id, count(*) AS n,
            min(attributes_json) AS first_json,
            max(json_extract_string(attributes_json, '$.purchase_order_id')) AS last_purchase_order,
            min(json_extract_string(attributes_json, '$.subscription_id')) AS first_subscription
            FROM labelled GROUP BY ALL""",
        ),
        "invoice_dates": with_(
            [EXPORT],
            """SELECT m.*, s.statements FROM (
              SELECT invoice.month AS invoice_month, invoice.month[1:4] || '-' || invoice.month[5:6] || '-01' AS invoice_date,
                strftime(min(usage_start_time), '%Y-%m-%d') AS first_day,
                strftime(max(usage_end_time), '%Y-%m-%d') AS last_day FROM export GROUP BY ALL) AS m
            LEFT JOIN (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS statements FROM orders
              GROUP BY ALL) AS s ON s.day = m.invoice_date""",
        ),
        "statement_union": with_(
            [STATEMENTS],
            "SELECT billing_model, invoice_month, count(*) AS n, max(invoice_date[9:10] || '-' || invoice_date[6:7] || '-'"
            " || invoice_date[1:4]) AS last_date, "
            + ", ".join(
                f"CAST(CAST(sum({x}) AS DECIMAL(24,5)) AS DOUBLE) AS {name}"
                for x, name in [
                    ("support", "TotalSupport"),
                    ("gcp", "Total_gcp"),
                    ("third", "Total_thirdparty"),
                    ("amount", "Importe__c"),
                    ("margin_support_maps", "Margen_soporte_maps_euros"),
                ]
            )
            + " FROM statements GROUP BY ALL",
        ),
        "statement_strings": with_(
            _STATEMENT_TABLES,
            "SELECT opportunity AS OpportunityId, "
            + ", ".join(
                [
                    _str("support", "TotalSupport_str"),
                    _str("gcp", "GCP_original_str"),
                    _str("amount", "Importe_str"),
                    _str("third", "Total_thirdparty_str"),
                    _str("charge", "Cargo_Google_str"),
                ]
            )
            + " FROM signed",
        ),
        "support_only_flag": with_(
            [STATEMENTS],
            """SELECT 'v1' AS view, billing_model, invoice_month, count(*) FILTER (gcp + gmp <= 0.01) AS support_only,
              count(*) AS n FROM statements GROUP BY ALL
            UNION ALL
            SELECT 'v2' AS view, billing_model, invoice_month, count(*) FILTER (support = amount) AS support_only,
              count(*) AS n FROM statements GROUP BY ALL""",
        ),
        "fx_convert": with_(
            [STATEMENTS],
            "SELECT iso AS Currency, invoice_month, "
            + ", ".join(
                f"CAST(CAST(sum(CAST(CAST({x} AS DECIMAL(18,5)) * CAST(inverse AS DECIMAL(6,5)) AS DECIMAL(24,9)))"
                f" AS DECIMAL(24,4)) AS DOUBLE) AS {name}"
                for x, name in [
                    ("support", "TotalSupport_EUR"),
                    ("gcp", "GCP_EUR"),
                    ("gmp", "GMP_EUR"),
                    ("gcp + gmp + third", "Importe_sin_soporte_EUR"),
                    ("charge", "Cargo_Google_EUR"),
                    ("amount", "Importe_EUR"),
                ]
            )
            + ", count(inverse) AS converted FROM statements GROUP BY ALL",
        ),
        "cargo_google": "SELECT billing_account_id, billing_model, invoice_month, account, total_gcp, total_gmp,"
        f" cargo_google FROM ({composite()['cost_by_account']}) AS v",
        "load_maps_services": "SELECT p_name AS sku, count(*) AS n FROM part GROUP BY ALL",
        "load_workspace_sku": _sheet(),
        "load_sku_third_party": """SELECT p_type AS service_name,
            CASE WHEN p_partkey % 4 <> 0 THEN '1998-01-01' END AS date_added, count(*) AS n,
            min('SKU-' || p_partkey) AS first_sku, max(p_name) AS last_name FROM part GROUP BY ALL""",
        "seed_currency_symbols": with_(
            _STATEMENT_TABLES,
            """SELECT iso AS CurrencyIsoCode__c, sign AS moneda, count(*) AS n FROM signed
            GROUP BY ALL""",
        ),
        "purge_month": " UNION ALL ".join([_left("temp", 0), _left("by_project", 1), _left("annual", 2)])
        + """ UNION ALL
            SELECT 'workspace' AS source, strftime(o_orderdate, '%Y')
              || CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE strftime(o_orderdate, '%m') END AS month, count(*) AS n,
              CAST(sum(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.5 AS DECIMAL(4,3))) AS DOUBLE) AS charge
            FROM orders WHERE o_orderkey % 40 = 0 OR strftime(o_orderdate, '%Y%m') <> '199810' GROUP BY ALL""",
    }
    twins["seed_payer_accounts"] = twins["j_payer_label"]
    twins["purge_month_partitioned"] = twins["purge_month"]
    return twins
