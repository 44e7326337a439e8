"""Monthly cost, credit and margin views: cloud, maps, both together, by account or by project."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.flags import amount_where, first_party_share, is_marketplace, is_third_party, third_party_share
from ..functions.services import CLOUD_EXCLUDED, MAPS_EXCLUDED, is_maps_service, is_support_fee
from ..operators.charges import charge_lines, flat, sum_charges
from ..operators.exact import as_stored, exact, is_floating, is_split, is_zero, summed, total
from ..operators.filters import account_format, rolling_months
from ..operators.lookups import (
    small_enough,
    with_maps_listing,
    with_payer_label,
    with_third_party_listing,
    without_maps_listing,
)

BASE = ["cost_gmp", "credits_gmp", "cost_gcp", "credits_gcp", "reseller_margin_gmp", "reseller_margin_gcp"]
THIRD_PARTY = ["cost_thirdparty", "cost_base_thirdparty", "credits_thirdparty"]
MARKETPLACE = [
    "cost_thirdparty_marketplace",
    "customer_cost_thirdparty_marketplace",
    "credits_thirdparty_marketplace",
]
SUMS = ["cost", "customer_cost", "credits", "margin"]
GRAIN = ["billing_account_id", "invoice_month", "currency", "account"]


def _grain(by_project: bool) -> list[str]:
    return [*GRAIN, "project_id"] if by_project else GRAIN


def _money(export: DataFrame) -> DataType:
    return export.schema["cost"].dataType


def _measured(skus: DataFrame | None, maps: DataFrame, payers: DataFrame) -> list[bool]:
    """Whether each lookup is small, by the columns that are joined; one job for all."""
    tables = [] if skus is None else [skus.select("sku_id")]
    return small_enough(*tables, maps.select("sku"), payers.select("payer_billing_account_id", "account_name"))


def _with_zeros(df: DataFrame, names: Sequence[str], like: str) -> DataFrame:
    zero = F.lit(0).cast(df.schema[like].dataType)
    return df.withColumns({name: zero for name in names})


def _ordered(df: DataFrame, measures: Sequence[str], by_project: bool) -> DataFrame:
    project = ["project_id"] if by_project else []
    return df.select(
        "billing_account_id", "invoice_month", *project, *measures[:6], "currency", "account", *measures[6:]
    )


def _before_joins(rows: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Rows ready for the lookup joins; summed first when a lookup is too big to broadcast.

    All later steps are sums, so summing by the raw keys changes no result; it leaves a far smaller table, without
    hot raw rows, to send through the sort-merge joins.
    """
    return rows if small else sum_charges(charge_lines(rows), keys, SUMS)


def _after_joins(rows: DataFrame, small: bool) -> DataFrame:
    """Unnest the credits of rows that were not summed before the joins."""
    return charge_lines(rows) if small else rows


def cloud_detail(
    export: DataFrame,
    skus: DataFrame,
    maps: DataFrame,
    payers: DataFrame,
    as_of: dt.date | None = None,
    *,
    by_project: bool = False,
    exclude: Sequence[str] = (),
    with_maps: bool = False,
    dedupe: bool = False,
    null_is_first_party: bool = False,
) -> DataFrame:
    """Level one of the cost views: exact sums per grain, flag pair and, for rows without a project, service and SKU.

    The split asks whether a detail group without project earned a margin, so those rows keep service and SKU as
    keys. Rows with a project are split by their flags alone; they are summed to the grain at once, which keeps the
    first shuffle small. ``with_maps`` keeps maps rows too (``is_maps``), so one scan serves both kinds.
    """
    small_skus, small_maps, small_payers = _measured(skus, maps, payers)
    small = small_skus and small_maps and small_payers
    rows = flat(rolling_months(account_format(export), as_of))
    service, sku = F.col("service"), F.col("sku")
    in_cloud = ~service.isin(list(exclude)) & ~is_support_fee(sku)
    if with_maps:
        rows = rows.filter(service.isNotNull())
    else:
        rows = rows.filter(~is_maps_service(service, F.lit(False)) & in_cloud)
    resold = is_third_party(F.lit(False), F.col("transaction_type"), F.col("seller_name"))
    market = is_marketplace(F.col("transaction_type"), F.col("seller_name"), service)
    if null_is_first_party:
        resold, market = F.coalesce(resold, F.lit(False)), F.coalesce(market, F.lit(False))
    rows = rows.withColumns({"resold": resold, "is_marketplace": market})

    dims = ["billing_account_id", "payer_billing_account_id", "invoice_month", "currency"]
    dims += ["service", "sku_id", "sku", "project_id", "resold", "is_marketplace"]
    lines = _before_joins(rows, dims, small)
    if with_maps:
        lines = with_maps_listing(lines, maps, small=small_maps)
        lines = lines.withColumn("is_maps", is_maps_service(service, F.col("maps_listed")))
        is_maps = F.col("is_maps")
        lines = lines.filter((is_maps & ~service.isin(MAPS_EXCLUDED)) | (~is_maps & in_cloud))
    else:
        lines = without_maps_listing(lines, maps, small=small_maps).withColumn("is_maps", F.lit(False))
        is_maps = F.lit(False)

    def cloud_only(value: Column) -> Column:
        return F.when(~is_maps, value)

    lines = with_third_party_listing(lines, skus, cloud_only(F.col("sku_id")), small=small_skus, dedupe=dedupe)
    lines = _after_joins(with_payer_label(lines, payers, small=small_payers), small)
    no_project = ~is_maps & F.col("project_id").isNull()
    lines = lines.withColumns(
        {
            "is_third_party": cloud_only(F.col("third_party_listed") | F.col("resold")),
            "is_marketplace": cloud_only(F.col("is_marketplace")),
            "project_is_null": no_project,
            "detail_service": F.when(no_project, service),
            "detail_sku": F.when(no_project, sku),
        }
    )
    keys = [*_grain(by_project), "is_maps", "is_third_party", "is_marketplace", "project_is_null"]
    return sum_charges(lines, [*keys, "detail_service", "detail_sku"], SUMS)


def split_parties(detail: DataFrame, money: DataType, *, by_project: bool = False) -> DataFrame:
    """Level two: split each detail group between first party, third party and marketplace, and sum to the grain.

    The results have the type ``money`` of the stored amounts; up to here all sums are exact.
    """
    unassigned = F.col("project_is_null") & is_zero(F.col("margin"), is_split(detail.schema["margin"].dataType))
    third, market = F.col("is_third_party"), F.col("is_marketplace")
    first = first_party_share(third, market, unassigned)
    other = third_party_share(third, market, unassigned)
    maps, cloud = F.col("is_maps"), ~F.col("is_maps")
    cost, customer, credits, margin = (F.col(c) for c in SUMS)
    columns = {
        "cost_gmp": (maps, cost),
        "credits_gmp": (maps, credits),
        "cost_gcp": (first, cost),
        "credits_gcp": (first, credits),
        "reseller_margin_gmp": (maps, margin),
        "reseller_margin_gcp": (cloud, margin),
        "cost_thirdparty": (other, customer),
        "cost_base_thirdparty": (other, cost),
        "credits_thirdparty": (other, credits),
        "cost_thirdparty_marketplace": (market, cost),
        "customer_cost_thirdparty_marketplace": (market, customer),
        "credits_thirdparty_marketplace": (market, credits),
    }
    kinds = detail.schema
    split = {m: is_split(kinds[m].dataType) for m in SUMS}
    of = dict(zip(columns, ["cost", "credits", "cost", "credits", "margin", "margin", "customer_cost", "cost", "credits", "cost", "customer_cost", "credits"], strict=True))
    sums = [
        (total(F.when(share, amount), True) if split[of[name]] else F.sum(amount_where(share, amount))).alias(name)
        for name, (share, amount) in columns.items()
    ]
    sums = as_stored(detail.groupBy(*_grain(by_project)).agg(*sums), list(columns), money)
    return _ordered(sums, list(columns), by_project)


def gcp_costs(
    export: DataFrame,
    skus: DataFrame,
    maps: DataFrame,
    payers: DataFrame,
    as_of: dt.date | None = None,
    *,
    exclude: Sequence[str] = tuple(CLOUD_EXCLUDED),
    dedupe: bool = False,
    null_is_first_party: bool = False,
) -> DataFrame:
    """Cloud costs per account, month, currency and payer label, with third-party and marketplace shares."""
    detail = cloud_detail(
        export, skus, maps, payers, as_of, exclude=exclude, dedupe=dedupe, null_is_first_party=null_is_first_party
    )
    return split_parties(detail, _money(export))


def gcp_costs_by_project(
    export: DataFrame,
    skus: DataFrame,
    maps: DataFrame,
    payers: DataFrame,
    as_of: dt.date | None = None,
    *,
    exclude: Sequence[str] = (),
    marketplace: bool = False,
    dedupe: bool = False,
    null_is_first_party: bool = False,
) -> DataFrame:
    """Cloud costs per project. Invoice and program lines stay in, and marketplace columns are left out, by default."""
    detail = cloud_detail(
        export,
        skus,
        maps,
        payers,
        as_of,
        by_project=True,
        exclude=exclude,
        dedupe=dedupe,
        null_is_first_party=null_is_first_party,
    )
    costs = split_parties(detail, _money(export), by_project=True)
    return costs if marketplace else costs.drop(*MARKETPLACE)


def gmp_costs(
    export: DataFrame,
    maps: DataFrame,
    payers: DataFrame,
    as_of: dt.date | None = None,
    *,
    by_project: bool = False,
) -> DataFrame:
    """Maps costs per account, month, currency and payer label (and project)."""
    small_maps, small_payers = _measured(None, maps, payers)
    small = small_maps and small_payers
    service = F.col("service")
    rows = flat(rolling_months(account_format(export), as_of)).filter(~service.isin(MAPS_EXCLUDED))
    dims = ["billing_account_id", "payer_billing_account_id", "invoice_month", "currency", "service"]
    lines = _before_joins(rows, [*dims, "project_id"] if by_project else dims, small)
    lines = with_maps_listing(lines, maps, small=small_maps).filter(is_maps_service(service, F.col("maps_listed")))
    lines = _after_joins(with_payer_label(lines, payers, small=small_payers), small)
    sums = sum_charges(lines, _grain(by_project), ["cost", "credits", "margin"])
    sums = as_stored(sums, ["cost", "credits", "margin"], _money(export))
    sums = sums.withColumnsRenamed({"cost": "cost_gmp", "credits": "credits_gmp", "margin": "reseller_margin_gmp"})
    sums = _with_zeros(sums, ["cost_gcp", "credits_gcp", "reseller_margin_gcp"], "cost_gmp")
    return _ordered(sums, BASE, by_project)


def gmp_costs_by_project(
    export: DataFrame,
    skus: DataFrame,
    maps: DataFrame,
    payers: DataFrame,
    as_of: dt.date | None = None,
    *,
    parity: bool = True,
) -> DataFrame:
    """The project view named after maps. In parity form it holds cloud costs, as users of that view know it."""
    if parity:
        return gcp_costs_by_project(export, skus, maps, payers, as_of)
    return _with_zeros(gmp_costs(export, maps, payers, as_of, by_project=True), THIRD_PARTY, "cost_gmp")


def monthly_costs(maps_costs: DataFrame, cloud_costs: DataFrame) -> DataFrame:
    """Both account views together, summed again; the maps side has no third-party share."""
    return _combine(maps_costs, cloud_costs, [*BASE, *THIRD_PARTY, *MARKETPLACE], by_project=False)


def monthly_costs_by_project(maps_costs: DataFrame, cloud_costs: DataFrame) -> DataFrame:
    """Both project views together, summed again."""
    return _combine(maps_costs, cloud_costs, [*BASE, *THIRD_PARTY], by_project=True)


def _combine(maps_costs: DataFrame, cloud_costs: DataFrame, measures: list[str], by_project: bool) -> DataFrame:
    keys = _grain(by_project)
    left = _with_zeros(maps_costs.select(*keys, *BASE), measures[6:], "cost_gmp")
    both = left.unionByName(cloud_costs.select(*keys, *measures))
    money = both.schema["cost_gmp"].dataType
    sums = both.groupBy(*keys).agg(*[_exact_sum(both, m).alias(m) for m in measures])
    return _ordered(as_stored(sums, measures, money), measures, by_project)


def _exact_sum(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return summed(exact(F.col(name), kind), is_floating(kind))


def monthly_costs_one_scan(
    export: DataFrame, skus: DataFrame, maps: DataFrame, payers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """:func:`monthly_costs` from one scan of the export instead of one per kind; the same rows."""
    detail = cloud_detail(export, skus, maps, payers, as_of, exclude=CLOUD_EXCLUDED, with_maps=True)
    return split_parties(detail, _money(export))


def monthly_costs_by_project_one_scan(
    export: DataFrame,
    skus: DataFrame,
    maps: DataFrame,
    payers: DataFrame,
    as_of: dt.date | None = None,
    *,
    parity: bool = True,
) -> DataFrame:
    """:func:`monthly_costs_by_project` from one scan.

    In parity form the two inputs are the same view, so its base amounts count twice and the rest once.
    """
    if parity:
        costs = gcp_costs_by_project(export, skus, maps, payers, as_of)
        return costs.withColumns({name: F.col(name) + F.col(name) for name in BASE})
    detail = cloud_detail(export, skus, maps, payers, as_of, by_project=True, with_maps=True)
    return split_parties(detail, _money(export), by_project=True).drop(*MARKETPLACE)
