"""Left, semi and anti joins to lookup tables: broadcast behind a size check, sort-merge beyond it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup within both bounds meets unsummed rows, as Spark then broadcasts it by default.
MAX_ROWS = 1_000_000
MAX_BYTES = 8 * 1024 * 1024


def small_enough(*tables: DataFrame) -> list[bool]:
    """Measure the tables (give the joined columns only) in one distributed job; for each, whether it is within both
    bounds."""

    def widths(df: DataFrame, number: int) -> DataFrame:
        text = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns])
        return df.select(F.lit(number).alias("number"), F.octet_length(text).alias("width"))

    rows = reduce(DataFrame.unionAll, [widths(df, i) for i, df in enumerate(tables)])
    sizes = rows.groupBy("number").agg(F.count(F.lit(1)).alias("rows"), F.sum("width").alias("bytes"))
    found = {size["number"]: size["rows"] <= MAX_ROWS and size["bytes"] <= MAX_BYTES for size in sizes.collect()}
    return [found.get(i, MAX_ROWS >= 0) for i in range(len(tables))]


def join_lookup(
    df: DataFrame, lookup: DataFrame, on: Column, how: str = "left", *, small: bool | None = None
) -> DataFrame:
    """Join a lookup. ``small`` comes from :func:`small_enough`.

    No broadcast is forced: Spark decides by the sizes it finds when the query runs, so a lookup that has grown since
    the plan was built is safe. One known not to be small meets the rows in a sort-merge join, whose hot (or NULL)
    keys the adaptive planner splits on the row side; left, semi and anti joins all allow that.
    """
    return df.join(lookup.hint("merge") if small is False else lookup, on, how)


def with_payer_label(df: DataFrame, payers: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Add ``account``, the payer's label, or ``Unknown``. A payer listed twice repeats its rows."""
    names = payers.select(F.col("payer_billing_account_id").alias("_payer"), F.col("account_name").alias("_label"))
    joined = join_lookup(df, names, F.col("payer_billing_account_id") == F.col("_payer"), small=small)
    return joined.withColumn("account", F.coalesce("_label", F.lit("Unknown"))).drop("_payer", "_label")


def with_maps_listing(df: DataFrame, maps: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Add ``maps_listed``. A service listed twice repeats its rows."""
    names = maps.select(F.col("sku").alias("_maps"))
    joined = join_lookup(df, names, F.col("service") == F.col("_maps"), small=small)
    return joined.withColumn("maps_listed", F.col("_maps").isNotNull()).drop("_maps")


def without_maps_listing(df: DataFrame, maps: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Keep rows whose service the maps lookup does not name; nothing can repeat."""
    names = maps.select(F.col("sku").alias("_maps"))
    return join_lookup(df, names, F.col("service") == F.col("_maps"), "left_anti", small=small)


def with_third_party_listing(
    df: DataFrame, skus: DataFrame, key: Column, *, small: bool | None = None, dedupe: bool = False
) -> DataFrame:
    """Add ``third_party_listed``. A SKU listed twice repeats its rows (and cost) unless ``dedupe`` is set."""
    ids = skus.select(F.col("sku_id").alias("_sku"))
    joined = join_lookup(df, ids.distinct() if dedupe else ids, key == F.col("_sku"), small=small)
    return joined.withColumn("third_party_listed", F.col("_sku").isNotNull()).drop("_sku")


def with_workspace_sku(df: DataFrame, skus: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Add the licence codes ``sku_sf_flex`` and ``sku_sf_month``."""
    codes = skus.select(F.col("sku_id").alias("_sku"), "sku_sf_flex", "sku_sf_month")
    return join_lookup(df, codes, F.col("sku_id") == F.col("_sku"), small=small).drop("_sku")


def with_contract(df: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add the contract columns; each contract of an account gives its own row.

    Used on grouped results only, so the join is left to Spark's own size estimates.
    """
    terms = contracts.select(
        F.col("billing_account_id__c").alias("_contract"),
        F.col("billing_account_desc__c").alias("contract_name"),
        F.col("Billing_Model__c").alias("billing_model"),
    )
    return df.join(terms, F.col("billing_account_id") == F.col("_contract"), "left").drop("_contract")


def with_currency_symbol(df: DataFrame, symbols: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Add ``moneda``, the currency's symbol, with the euro sign for an unknown currency."""
    signs = symbols.select(F.col("currency_iso_code").alias("_iso"), F.col("symbol").alias("_symbol"))
    joined = join_lookup(df, signs, F.col("CurrencyIsoCode__c") == F.col("_iso"), small=small)
    return joined.withColumn("moneda", F.coalesce("_symbol", F.lit("€"))).drop("_iso", "_symbol")
