from __future__ import annotations

import datetime as dt

import pytest

from builders import dicts, plain
from tallybook.plans.statements import statement_lines, statement_lines_v2
from tallybook.sources import schemas

pytestmark = pytest.mark.usefixtures("interpreted")


def line(schema, **changes):
    base = {
        "billing_account_id": "A-B-C", "Dominio__c": "d", "OpportunityId__c": "o", "SKU__c": 1.0,
        "CurrencyIsoCode__c": "USD", "TotalSupport": 5.0, "Total_gcp": 10.0, "Total_gmp": 20.0, "Importe__c": 100.0,
        "Cargo_Google__c": 50.0, "invoice_month": "202501", "cambio_aplicado": 4.0,
        "Total_thirdparty": "1.5" if schema is schemas.STATEMENTS_BY_PROJECT else 1.5,
    }
    base["invoice_date" if schema is schemas.STATEMENTS_BY_PROJECT else "invoce_date"] = "01-02-2025"
    values = {**base, **changes}
    return tuple(values.get(f.name) for f in schema.fields)


def statement(spark, plan=statement_lines, flexible=(), project=(), annual=(), **options):
    sources = [
        spark.createDataFrame([line(schema, **r) for r in rows], schema)
        for schema, rows in [
            (schemas.STATEMENTS_FLEXIBLE, flexible),
            (schemas.STATEMENTS_BY_PROJECT, project),
            (schemas.STATEMENTS_ANNUAL, annual),
        ]
    ]
    symbols = spark.createDataFrame([("USD", "$")], schemas.CURRENCY_SYMBOLS)
    return [{k: plain(v) for k, v in r.items()} for r in dicts(plan(*sources, symbols, **options))]


def test_three_sources_share_one_shape(spark):
    got = statement(spark, flexible=[{}], project=[{}], annual=[{}])
    assert {r["billing_model"] for r in got} == {"Flexible", "Flexibles desglosadas", "Anuales"}
    for r in got:
        assert r["ThirdParty_original"] == 1.5 and r["Importe_sin_soporte_original"] == 31.5
        assert r["Importe_sin_soporte_EUR"] == 7.875 and r["Importe_EUR"] == 25
        assert r["invoice_date"] == dt.date(2025, 2, 1)
        assert (r["TotalSupport_str"], r["Importe_str"]) == ("$5", "$100")


def test_missing_third_party_total_leaves_the_sum_null(spark):
    (got,) = statement(spark, flexible=[{"Total_thirdparty": None}])
    assert got["Importe_sin_soporte_original"] is None and got["Importe_sin_soporte_EUR"] is None
    (got,) = statement(spark, statement_lines_v2, flexible=[{"Total_thirdparty": None}])
    assert got["Total_thirdparty_str"] is None and got["Importe_GCP_Eur"] == 7.5


def test_unknown_currency_shows_the_euro_sign(spark):
    got = statement(spark, flexible=[{"CurrencyIsoCode__c": "COP"}, {"CurrencyIsoCode__c": None}])
    assert [r["GCP_original_str"] for r in got] == ["€10", "€10"]


def test_rates(spark):
    (got,) = statement(spark, flexible=[{"cambio_aplicado": None}])
    assert got["GCP_EUR"] is None and got["GCP_original"] == 10
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        statement(spark, flexible=[{"cambio_aplicado": 0.0}])
    (got,) = statement(spark, flexible=[{"cambio_aplicado": 0.0}], strict=False)
    assert got["GCP_EUR"] is None


def test_support_only_flags_differ_between_the_views(spark):
    rows = [
        {"Total_gcp": 0.0, "Total_gmp": 0.01, "TotalSupport": 5.0, "Importe__c": 6.0},
        {"TotalSupport": 6.0, "Importe__c": 6.0},
        {"Total_gcp": None, "TotalSupport": None},
    ]
    assert [r["LecturasSoloSoporte"] for r in statement(spark, flexible=rows)] == [1, 0, 0]
    assert [r["LecturasSoloSoporte"] for r in statement(spark, statement_lines_v2, flexible=rows)] == [0, 1, 0]


def test_nine_decimals_survive(spark):
    (got,) = statement(spark, flexible=[{"Total_gcp": 0.123456789, "cambio_aplicado": 3.0}])
    assert got["GCP_original_str"] == "$0.123456789" and got["GCP_EUR"] == 0.041152263
