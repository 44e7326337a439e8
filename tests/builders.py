"""Small export rows by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DecimalType

from tallybook.sources import schemas

AS_OF = dt.date(2025, 5, 20)
MONEY = DecimalType(18, 4)
SCHEMA = schemas.export_schema(MONEY)


def amount(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def row(**changes) -> tuple:
    """A first-party cloud line; nested fields are given by their flat names."""
    base = {
        "account": "A-B-C",
        "payer": "P1",
        "month": "202504",
        "service_id": "S1",
        "service": "BigQuery",
        "sku_id": "K1",
        "sku": "sku one",
        "project": "proj",
        "cost": 10,
        "customer_cost": 12,
        "credits": [],
        "currency": "EUR",
        "rate": 1.0,
        "usage": 1.0,
        "start": dt.datetime(2025, 4, 2),
        "end": dt.datetime(2025, 4, 3),
        "export_time": dt.datetime(2025, 4, 10, 5),
        "labels": None,
        "transaction_type": "GOOGLE",
        "seller": None,
        "cost_type": "regular",
        "adjustment": None,
    }
    assert not set(changes) - set(base), set(changes) - set(base)
    v = {**base, **changes}
    credits = None if v["credits"] is None else [(kind, amount(a)) for kind, a in v["credits"]]
    return (
        v["account"], v["payer"], (v["month"],), (v["service_id"], v["service"]), (v["sku_id"], v["sku"]),
        (v["project"],), amount(v["cost"]), amount(v["customer_cost"]), credits, v["currency"], v["rate"],
        (v["usage"], "seat"), v["start"], v["end"], v["export_time"], v["labels"], v["transaction_type"], v["seller"],
        v["cost_type"], v["adjustment"],
    )


def export(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([row(**r) for r in rows], SCHEMA)


def payers(spark: SparkSession, *entries: tuple[str, str]) -> DataFrame:
    return spark.createDataFrame(list(entries or [("P1", "Payer one")]), schemas.PAYER_ACCOUNTS)


def maps(spark: SparkSession, *names: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], schemas.MAPS_SERVICES)


def skus(spark: SparkSession, *ids: str) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], schemas.THIRD_PARTY_SKUS)


def licences(spark: SparkSession, *ids: str) -> DataFrame:
    rows = [(i, f"FLEX {i}", f"MONTH {i}", "S", "service", "sku") for i in ids]
    return spark.createDataFrame(rows, schemas.WORKSPACE_SKUS)


def dicts(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def one(df: DataFrame) -> dict:
    rows = dicts(df)
    assert len(rows) == 1, rows
    return {k: plain(v) for k, v in rows[0].items()}


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    names = sorted(a.columns)
    assert names == sorted(b.columns)

    def rows(df):
        return sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr)

    return rows(a) == rows(b)
