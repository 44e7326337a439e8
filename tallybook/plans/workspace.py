"""Workspace licences: flexible seats per order, commitments line by line, seat changes beside a commitment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.dates import invoice_date
from ..operators.attributes import with_attributes
from ..operators.exact import as_stored, exact, is_floating, is_zero, shown, summed
from ..operators.filters import rolling_months
from ..operators.lookups import join_lookup, small_enough, with_workspace_sku
from ..session import fresh_folder

# Usage types.
FLEXIBLE = "FLEXIBLE_SEATS_ITEM"
COMMITMENTS = ["COMMITMENT_MONTHLY_ITEM", "COMMITMENT_TERM_START_ITEM"]
SEAT_CHANGE = "COMMITMENT_SEATS_CHANGE_ITEM"

COLUMNS = [
    "billing_account_id",
    "payer_billing_account_id",
    "invoice_month",
    "invoice_date",
    "usage_amount",
    "usage_unit",
    "google_charge",
    "currency",
    "currency_conversion_rate",
    "service_id",
    "service_description",
    "sku_id",
    "sku_description",
    "usage_start_time",
    "usage_end_time",
    "export_time",
    "sku_sf",
    "match_sf",
    "attributes_json",
    "domain_name",
    "order_id",
    "purchase_order_id",
    "subscription_id",
    "usage_type",
]
SEAT_KEYS = ["invoice_month", "domain_name", "sku_id"]


def licence_rows(export: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Charged rows of the window that may be licence rows, with their attributes.

    Filters run from cheap to dear: window and cost at the scan, then the usage type, once the label array has been
    read. The object text is parsed only where odd characters change its meaning. The users of these rows select by
    ``usage_type`` themselves, too.
    """
    wanted = [FLEXIBLE, SEAT_CHANGE, *COMMITMENTS]
    rows = rolling_months(export, as_of).filter(F.col("cost") != 0)
    rows = rows.select(
        "billing_account_id",
        "payer_billing_account_id",
        F.col("invoice.month").alias("invoice_month"),
        F.col("usage.amount").alias("usage_amount"),
        F.col("usage.unit").alias("usage_unit"),
        F.col("cost").alias("google_charge"),
        "currency",
        "currency_conversion_rate",
        F.col("service.id").alias("service_id"),
        F.col("service.description").alias("service_description"),
        F.col("sku.id").alias("sku_id"),
        F.col("sku.description").alias("sku_description"),
        F.to_date("usage_start_time").alias("usage_start_time"),
        F.to_date("usage_end_time").alias("usage_end_time"),
        "export_time",
        "system_labels",
    )
    return with_attributes(rows).filter(F.col("usage_type").isin(wanted))


def written_once(rows: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back; a stage for :func:`workspace_charges`."""
    folder = fresh_folder(rows.sparkSession, "licence_rows")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def grouped_once(rows: DataFrame, totals: dict[str, Column] | None = None) -> DataFrame:
    """The same rows out of one shuffle that all their uses share, so they are computed once without being written.

    Equal rows are counted and unfolded again. All columns are keys, so no value is hot and none is pruned. The columns
    that uses filter by, or need not null for a join, are taken only where the count is positive, which it always is:
    such filters can't be moved below the grouping, so what is below the shuffle is alike in all uses, and adaptive
    execution runs it once. Keys and counts alone are grouped by hashing; the smallest text of a group needs a sort.

    With ``totals`` (name and aggregate of columns of ``rows``) those are the columns kept beside ``usage_type`` and
    the seat keys, one row for each, for uses that add rows up by no more than these.
    """
    asked = ["usage_type", *SEAT_KEYS]
    keys = asked if totals else rows.columns
    renamed = rows.withColumnsRenamed({c: f"_{c}" for c in asked})
    counts = [F.count(F.lit(1)).cast("int").alias("_n"), *[total.alias(name) for name, total in (totals or {}).items()]]
    counted = renamed.groupBy(*[f"_{c}" if c in asked else c for c in keys]).agg(*counts)
    # true of every group, and asks for all aggregates, so that no use leaves one out
    there = (F.greatest("_n", *[F.col(c).isNotNull().cast("int") for c in totals]) if totals else F.col("_n")) > 0
    counted = counted.withColumns({c: F.when(there, F.col(f"_{c}")) for c in asked})
    if totals:
        return counted.select(*asked, *totals)
    return counted.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).select(*rows.columns)


def _average(amount: Column, kind: DataType) -> Column:
    """The mean; of floating amounts that of their exact sum, so rounding it doesn't depend on the order of rows."""
    return shown(summed(exact(amount, kind), True)) / F.count(amount) if is_floating(kind) else F.avg(amount)


def flexible_seats(rows: DataFrame) -> DataFrame:
    """Flexible seats summed per order; of columns that differ within an order the smallest value is shown."""
    money = rows.schema["google_charge"].dataType
    keys = ["billing_account_id", "payer_billing_account_id", "invoice_month", "currency", "currency_conversion_rate"]
    keys += ["service_id", "service_description", "sku_id", "sku_description", "domain_name", "order_id", "sku_sf"]
    sums = (
        rows.filter(F.col("usage_type") == FLEXIBLE)
        .withColumn("sku_sf", F.col("sku_sf_flex"))
        .groupBy(*keys)
        .agg(
            summed(exact(F.col("google_charge"), money), is_floating(money)).alias("google_charge"),
            F.round(_average(F.abs("usage_amount"), rows.schema["usage_amount"].dataType)).alias("usage_amount"),
            F.min("usage_unit").alias("usage_unit"),
            F.min("usage_start_time").alias("usage_start_time"),
            F.max("usage_end_time").alias("usage_end_time"),
            F.max("export_time").alias("export_time"),
            F.min("attributes_json").alias("attributes_json"),
            F.min("purchase_order_id").alias("purchase_order_id"),
            F.min("subscription_id").alias("subscription_id"),
        )
    )
    sums = sums.withColumn("usage_type", F.lit(FLEXIBLE)).filter(~is_zero(F.col("google_charge"), is_floating(money)))
    return as_stored(sums, ["google_charge"], money)


def commitment_rows(rows: DataFrame, *, measure: bool = False) -> DataFrame:
    """Commitments as they are, and seat changes with a commitment of the same month, domain and SKU.

    The commitment side is reduced to its distinct keys before it meets the seat changes; a NULL domain never matches.
    ``measure`` counts those keys first to choose the join, which pays when the rows are stored.
    """
    is_commitment = F.col("usage_type").isin(COMMITMENTS)
    keys = rows.filter(is_commitment).select(*SEAT_KEYS).dropna().distinct()
    renamed = keys.toDF(*[f"_{k}" for k in SEAT_KEYS])
    # one pass for both kinds: the keys are distinct, so no row repeats, and only seat changes need one
    same = F.col("usage_type") == SEAT_CHANGE
    for k in SEAT_KEYS:
        same = same & (F.col(k) == F.col(f"_{k}"))
    both = rows.filter(is_commitment | (F.col("usage_type") == SEAT_CHANGE))
    found = join_lookup(both, renamed, same, small=small_enough(keys)[0] if measure else None)
    kept = found.filter(is_commitment | F.col(f"_{SEAT_KEYS[0]}").isNotNull())
    return kept.drop(*renamed.columns).withColumn("sku_sf", F.col("sku_sf_month"))


def workspace_charges(
    export: DataFrame,
    skus: DataFrame,
    as_of: dt.date | None = None,
    *,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Licence charges of the window.

    The licence rows are used three times (seats, commitments with seat changes, commitment keys), from one scan of
    the export: ``stage`` makes them available to all, by default :func:`grouped_once`; :func:`written_once` stores them
    in the shared folder, which also saves computing them again where the view is read more than once.
    ``match_sf`` is true where the licence code is missing; users of the view rely on that.
    """
    rows = (stage or grouped_once)(licence_rows(export, as_of))
    rows = with_workspace_sku(rows, skus, small=small_enough(skus.select("sku_id", "sku_sf_flex", "sku_sf_month"))[0])
    both = flexible_seats(rows).unionByName(
        commitment_rows(rows, measure=stage is not None).drop("sku_sf_flex", "sku_sf_month")
    )
    return both.withColumns(
        {"invoice_date": invoice_date(F.col("invoice_month")), "match_sf": F.col("sku_sf").isNull()}
    ).select(*COLUMNS)
