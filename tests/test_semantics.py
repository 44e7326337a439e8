"""One small case per rule that is easy to get wrong."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from builders import AS_OF, dicts, export, licences, maps, one, payers, plain, skus
from tallybook.functions.dates import statement_date, window_start
from tallybook.functions.labels import attribute, label_name, label_value
from tallybook.functions.money import in_euros, numeric, numeric_text
from tallybook.functions.services import is_maps_service
from tallybook.operators.attributes import with_attributes
from tallybook.operators.charges import charge_lines, flat
from tallybook.operators.filters import account_format, delete_where, rolling_months
from tallybook.plans import accounts, costs, invoice, workspace

pytestmark = pytest.mark.usefixtures("interpreted")


def gcp(spark, *rows, third=(), listed=(), plan=costs.gcp_costs, **options):
    return plan(export(spark, *rows), skus(spark, *third), maps(spark, *listed), payers(spark), AS_OF, **options)


def gmp(spark, *rows, listed=()):
    return costs.gmp_costs(export(spark, *rows), maps(spark, *listed), payers(spark), AS_OF)


RESOLD = {"transaction_type": "THIRD_PARTY_RESELLER"}


def test_null_transaction_type_lands_in_no_bucket(spark):
    got = one(gcp(spark, {"transaction_type": None, "cost": 5}))
    assert got["cost_gcp"] == got["cost_base_thirdparty"] == got["cost_thirdparty_marketplace"] == 0
    assert one(gcp(spark, {"transaction_type": None, "cost": 5}, null_is_first_party=True))["cost_gcp"] == 5


def test_null_transaction_type_without_project_or_margin_is_third_party(spark):
    got = one(gcp(spark, {"transaction_type": None, "cost": 5, "customer_cost": 6, "project": None}))
    assert (got["cost_gcp"], got["cost_base_thirdparty"], got["cost_thirdparty"]) == (0, 5, 6)


def test_null_transaction_type_with_seller_lands_in_no_bucket_even_without_project(spark):
    got = one(gcp(spark, {"transaction_type": None, "seller": "x", "project": None, "cost": 5}))
    assert got["cost_gcp"] == got["cost_base_thirdparty"] == got["cost_thirdparty_marketplace"] == 0


def test_listed_sku_with_seller_counts_as_third_party_and_marketplace(spark):
    got = one(gcp(spark, {**RESOLD, "seller": "x", "cost": 5}, third=["K1"]))
    assert (got["cost_gcp"], got["cost_base_thirdparty"], got["cost_thirdparty_marketplace"]) == (0, 5, 5)


def test_compute_engine_with_seller_stays_first_party(spark):
    got = one(gcp(spark, {**RESOLD, "seller": "x", "service": "Compute Engine", "cost": 5}))
    assert (got["cost_gcp"], got["cost_thirdparty_marketplace"]) == (5, 0)


def test_margin_is_tested_per_service_and_sku_when_the_project_is_missing(spark):
    """Two SKUs without project: only the one whose margins cancel out is third party."""
    rows = [
        {"project": None, "sku": "a", "cost": 1, "credits": [("RESELLER_MARGIN", -2)]},
        {"project": None, "sku": "b", "cost": 10, "credits": [("RESELLER_MARGIN", -2)]},
        {"project": None, "sku": "b", "cost": 20, "credits": [("RESELLER_MARGIN", 2)]},
        {"project": "p", "sku": "c", "cost": 100},
    ]
    got = one(gcp(spark, *rows))
    assert (got["cost_gcp"], got["cost_base_thirdparty"], got["reseller_margin_gcp"]) == (101, 30, -2)
    by_project = {r["project_id"]: r for r in dicts(gcp(spark, *rows, plan=costs.gcp_costs_by_project))}
    assert plain(by_project[None]["cost_gcp"]) == 1 and plain(by_project["p"]["cost_gcp"]) == 100


def test_null_service_is_neither_cloud_nor_maps(spark):
    assert dicts(gcp(spark, {"service": None})) == [] and dicts(gmp(spark, {"service": None})) == []


def test_null_sku_is_dropped_from_cloud_but_not_from_maps(spark):
    assert dicts(gcp(spark, {"sku": None})) == []
    assert one(gmp(spark, {"sku": None, "service": "Places API"}))["cost_gmp"] == 10


@pytest.mark.parametrize(
    "name, expected",
    [("Cloud maps beta", True), ("MAPS LEGACY", False), ("Marketplace", False), ("Placement", True), ("Maps", True),
     ("Geocoding API", True), ("Custom", True), ("Other", False), (None, None)],
)
def test_maps_names(spark, name, expected):
    df = spark.createDataFrame([(name,)], "s string")
    listed = F.coalesce(F.col("s") == "Custom", F.lit(False))
    # A NULL name is never listed, so the test stays NULL and both views drop the row.
    assert df.select(is_maps_service(F.col("s"), listed)).first()[0] is expected


def test_maps_leaves_out_its_own_list(spark):
    rows = [{"service": s} for s in ("Maps Reseller Program", "Anthos", "Maps API")]
    assert one(gmp(spark, *rows))["cost_gmp"] == 10


def test_account_view_drops_program_lines_and_project_view_keeps_them(spark):
    rows = [{"service": s} for s in ("Invoice", "Reseller Program", "SendGrid", "BigQuery")]
    assert one(gcp(spark, *rows))["cost_gcp"] == 10
    assert one(gcp(spark, *rows, plan=costs.gcp_costs_by_project))["cost_gcp"] == 40


def test_duplicate_lookup_entries(spark):
    assert one(gcp(spark, {}, third=["K1", "K1"]))["cost_base_thirdparty"] == 20
    assert one(gcp(spark, {}, third=["K1", "K1"], dedupe=True))["cost_base_thirdparty"] == 10
    assert one(gmp(spark, {"service": "X"}, listed=["X", "X"]))["cost_gmp"] == 20
    assert dicts(gcp(spark, {"service": "X"}, listed=["X", "X"])) == []
    assert one(gcp(spark, {"service": "Y"}, listed=["X", "X"]))["cost_gcp"] == 10


def test_unmapped_and_missing_payers_are_unknown(spark):
    got = dicts(gcp(spark, {"payer": "P9"}, {"payer": None}, {"payer": "P1"}))
    assert {r["account"]: plain(r["cost_gcp"]) for r in got} == {"Unknown": 20, "Payer one": 10}


def test_credit_types(spark):
    kinds = [("RESELLER_MARGIN", -1), (None, -2), ("PROMOTION", -4), ("RESELLERxMARGIN", -8), ("DISCOUNT", None)]
    got = one(gcp(spark, {"credits": kinds}))
    assert (got["credits_gcp"], got["reseller_margin_gcp"]) == (-6, -1)
    bill = one(invoice.reseller_invoice(export(spark, {"credits": kinds}), payers(spark)))
    assert (bill["creditos"], bill["creditos_reseller"], bill["all_creditos"]) == (-14, -1, -15)


def test_missing_and_empty_credits_keep_the_cost(spark):
    got = one(gcp(spark, {"credits": None}, {"credits": []}, {"credits": [("RESELLER_MARGIN", -1)]}))
    assert (got["cost_gcp"], got["credits_gcp"], got["reseller_margin_gcp"]) == (30, 0, -1)


def test_line_credit_sums(spark):
    df = export(spark, {"credits": None}, {"credits": []}, {"credits": [("RESELLER_MARGIN", -1)]},
                {"credits": [(None, None)]}, {"credits": [("A", 1), (None, 2), ("RESELLER_MARGIN", 4)]})
    lines = charge_lines(flat(df.withColumn("project", F.struct(F.monotonically_increasing_id().cast("string").alias("id")))))
    got = lines.groupBy("project_id").agg(F.sum("all_credits"), F.sum("margin"), F.sum("credits"), F.sum("cost")).collect()
    assert sorted((tuple(plain(v) for v in r[1:4]) for r in got), key=str) == sorted(
        [(None, None, None), (None, None, None), (-1, -1, None), (None, None, None), (7, 4, 3)], key=str
    )
    assert {plain(r[4]) for r in got} == {10}


@pytest.mark.parametrize("kind", ["double", "decimal(18,9)"])
def test_small_credits_are_not_cut(spark, kind):
    df = export(spark, {"credits": [("A", 1), ("A", 1)]})
    df = df.withColumn("credits", F.expr(f"transform(credits, (c, i) -> named_struct('type', c.type, 'amount', CAST(0.00003 + i * 0.00001 AS {kind})))"))
    assert plain(charge_lines(flat(df)).agg(F.sum("all_credits").cast("double")).first()[0]) == 0.00007


def attributes_json(labels):
    """The labels as object text, names shortened; what ``with_attributes`` must give."""
    quote = F.lit('"')
    entries = F.transform(labels, lambda kv: F.concat(quote, label_name(kv["key"]), F.lit('": "'), kv["value"], quote))
    return F.concat(F.lit("{"), F.coalesce(F.array_join(entries, ", "), F.lit("")), F.lit("}"))


def test_window_edges(spark):
    edge = dt.datetime(2025, 2, 1)
    df = export(spark, {"export_time": edge, "cost": 1}, {"export_time": edge - dt.timedelta(microseconds=1), "cost": 2},
                {"export_time": dt.datetime(2030, 1, 1), "cost": 4}, {"export_time": None, "cost": 8})
    assert plain(rolling_months(df, AS_OF).agg(F.sum("cost")).first()[0]) == 5


def test_window_default_is_today(spark):
    first, today = spark.range(1).select(window_start(), F.current_date()).first()
    assert first.day == 1 and (today.year * 12 + today.month) - (first.year * 12 + first.month) == 3


def test_account_format(spark):
    df = export(spark, *({"account": a} for a in ("A-B-C", "A-B", "plain", "--", None)))
    assert [r[0] for r in account_format(df).select("billing_account_id").collect()] == ["A-B-C", "--"]


def test_project_dashboard_names_adjustments(spark):
    contracts = spark.createDataFrame(
        [("A-B-C", "name", "Flexible"), ("A-B-C", "name", "Anual")],
        "billing_account_id__c string, billing_account_desc__c string, Billing_Model__c string",
    )
    monthly = costs.monthly_costs_by_project_one_scan(
        export(spark, {"project": None, "credits": [("RESELLER_MARGIN", -1)]}), skus(spark), maps(spark),
        payers(spark), AS_OF,
    )
    got = dicts(accounts.cost_by_project(monthly, contracts))
    assert [r["project_id"] for r in got] == ["<<<Google Adjustments>>>"] * 2
    assert [plain(r["cost_gcp"]) for r in got] == [20, 20]


def test_invoice_months(spark):
    rows = [
        {"month": "202503", "service": "Reseller Program", "cost": -5},
        {"month": "202504", "service": "Maps Reseller Program", "cost": -7},
        {"month": "202504", "cost": 100, "credits": [("RESELLER_MARGIN", -3), (None, -1)]},
        {"month": "202504", "service": "Invoice", "cost": 1000},
        {"month": "202504", "service": None, "cost": 1000},
        {"month": None, "cost": 2},
        {"month": None, "service": "Reseller Program", "cost": -9},
    ]
    got = dicts(invoice.reseller_invoice(export(spark, *rows), payers(spark)))
    assert [r["invoice_month"] for r in got] == ["202504", None]
    known, unknown = ({k: plain(v) for k, v in r.items()} for r in got)
    assert (known["consumo"], known["cost"]) == (99, 100)
    assert (known["descuento_reseller_old"], known["descuento_reseller_new"]) == (-7, -3)
    assert known["descuento_reseller"] == -10
    assert unknown["descuento_reseller_old"] == 0


def test_invoice_since(spark):
    rows = [{"month": "202401", "export_time": dt.datetime(2024, 1, 5)}, {}]
    got = invoice.reseller_invoice(export(spark, *rows), payers(spark), since=dt.date(2025, 1, 1))
    assert [r["invoice_month"] for r in got.collect()] == ["202504"]


def test_support_fee_repeats_per_contract_name(spark):
    contracts = spark.createDataFrame(
        [("A-B-C", "one", "x"), ("A-B-C", "one", "y"), ("A-B-C", "two", "z")],
        "billing_account_id__c string, billing_account_desc__c string, Billing_Model__c string",
    )
    fee = {"sku": "GCP Partner-led Enhanced Support Variable Fee", "credits": [("RESELLER_MARGIN", -1), ("A", -2)]}
    got = dicts(invoice.support_fee(export(spark, fee, fee, {}), contracts, payers(spark), AS_OF))
    assert {r["dominio"]: (plain(r["cost"]), plain(r["reseller_margin_gcp"])) for r in got} == {
        "one": (40, -4), "two": (20, -2)
    }


def test_adjustments_have_no_window_and_no_account_filter(spark):
    old = {"export_time": dt.datetime(2001, 1, 1), "account": "plain", "cost_type": "adjustment",
           "adjustment": ("why", "GENERAL"), "payer": None}
    got = one(invoice.billing_adjustments(export(spark, old, {}), payers(spark)))
    assert (got["adjustment_description"], got["account"]) == ("why", "Unknown")


# Labels and licences


def labels_frame(spark, *pairs):
    return spark.createDataFrame([([(k, v) for k, v in pairs],)], "l array<struct<key:string,value:string>>")


@pytest.mark.parametrize(
    "pairs, text",
    [
        ([("a/b/usage_type", "X"), ("plain", "1")], '{"usage_type": "X", "plain": "1"}'),
        ([("bad/", "z"), ("ok", "1")], '{"ok": "1"}'),
        ([("k", None), (None, "v"), ("ok", "1")], '{"ok": "1"}'),
        ([], "{}"),
    ],
)
def test_attribute_text(spark, pairs, text):
    assert labels_frame(spark, *pairs).select(attributes_json(F.col("l"))).first()[0] == text


def test_missing_labels_give_empty_object(spark):
    df = spark.sql("SELECT CAST(NULL AS ARRAY<STRUCT<key:STRING,value:STRING>>) AS l")
    assert df.select(attributes_json(F.col("l"))).first()[0] == "{}"


def test_first_duplicate_wins_and_quotes_break_the_text_form_only(spark):
    both = labels_frame(spark, ("x/k", "1"), ("k", "2"))
    quoted = labels_frame(spark, ("k", 'a"b'))

    def values(df):
        labels = F.col("l")
        return tuple(df.select(attribute(attributes_json(labels), "k"), label_value(labels, "k")).first())

    assert values(both) == ("1", "1")
    assert values(quoted) == (None, 'a"b')


def test_array_and_text_forms_agree(spark):
    """The short way round the parser gives what the parser gives, odd characters included."""
    pick = random.Random(5)
    keys = ["usage_type", "x/usage_type", "a/b/usage_type", "usage_type/", "other", "", "x/", None, 'usage_type"', "é"]
    values = ["FLEX", "", "a b", "a, b: {c}", 'q"uote', "back\\u0041", "tab\t", "line\n", "é€", None, '", "usage_type": "X']
    rows = [([(pick.choice(keys), pick.choice(values)) for _ in range(pick.randrange(5))],) for _ in range(600)]
    df = spark.createDataFrame(rows + [(None,)], "l array<struct<key:string,value:string>>")
    text = attributes_json(F.col("l"))
    df = df.select("l", text.alias("text"), attribute(text, "usage_type").alias("parsed"))
    got = with_attributes(df, "l").select("text", "attributes_json", "parsed", "usage_type").collect()
    assert [r for r in got if r["text"] != r["attributes_json"] or r["parsed"] != r["usage_type"]] == []
    assert len(got) == 601 and len({r["parsed"] for r in got}) > 4


def test_usage_type_hidden_in_odd_text_is_found(spark):
    hidden = {"labels": [("k", 'v", "usage_type": "COMMITMENT_MONTHLY_ITEM')]}
    escaped = {"labels": [("usage_type", "COMMITMENT_MONTHLY\\u005fITEM")], "cost": 3}
    broken = {"labels": [("usage_type", "COMMITMENT_MONTHLY_ITEM"), ("k", 'a"b')], "cost": 5}
    got = charges(spark, hidden, escaped, broken)
    assert {plain(r["google_charge"]) for r in got.collect()} >= {10, 3}


def licence(kind, domain="d", **changes):
    return {"labels": [("x/usage_type", kind), ("domain_name", domain), ("y/order_id", "o")], **changes}


def charges(spark, *rows, codes=("K1",), stage=None):
    return workspace.workspace_charges(export(spark, *rows), licences(spark, *codes), AS_OF, stage=stage)


@pytest.mark.parametrize("stage", [None, workspace.written_once])
def test_seat_changes_need_a_commitment(spark, stage):
    change = "COMMITMENT_SEATS_CHANGE_ITEM"
    rows = [
        licence("COMMITMENT_MONTHLY_ITEM"), licence(change, cost=1), licence(change, "other", cost=2),
        licence(change, sku_id="K2", cost=4), licence(change, month="202503", cost=8),
        licence("COMMITMENT_TERM_START_ITEM", None, cost=16), licence(change, None, cost=32),
        licence("COMMITMENT_SEATS_CHANGE", cost=64),
    ]
    got = charges(spark, *rows, stage=stage)
    assert sorted(plain(r["google_charge"]) for r in got.collect()) == [1, 10, 16]


def test_flexible_seats(spark):
    rows = [
        licence("FLEXIBLE_SEATS_ITEM", cost=3, usage=-2.0), licence("FLEXIBLE_SEATS_ITEM", cost=4, usage=3.0),
        licence("FLEXIBLE_SEATS_ITEM", cost=0, usage=99.0), licence("OTHER", cost=5), {"labels": None, "cost": 6},
        licence("FLEXIBLE_SEATS_ITEM", "gone", cost=5), licence("FLEXIBLE_SEATS_ITEM", "gone", cost=-5),
    ]
    got = one(charges(spark, *rows))
    assert (got["google_charge"], got["usage_amount"], got["sku_sf"], got["match_sf"]) == (7, 3, "FLEX K1", False)
    assert got["invoice_date"] == dt.date(2025, 4, 1)


def test_match_flag_is_true_without_a_licence_code(spark):
    got = one(charges(spark, licence("COMMITMENT_MONTHLY_ITEM"), codes=["K9"]))
    assert got["sku_sf"] is None and got["match_sf"] is True


# Money and dates


@pytest.mark.parametrize(
    "value, text", [("12.5", "12.5"), ("100", "100"), ("0", "0"), ("-0.000000001", "-0.000000001"), ("1200.30", "1200.3")]
)
def test_numeric_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(numeric_text(numeric(F.col("v")))).first()[0] == text


def test_numeric_text_of_any_scale(spark):
    df = spark.sql("SELECT CAST(1200 AS DECIMAL(10, 0)) a, CAST(-100 AS DECIMAL(38, 9)) b, 50 c, CAST(0.50 AS DECIMAL(4, 2)) d")
    assert tuple(df.select(*[numeric_text(F.col(c)) for c in "abcd"]).first()) == ("1200", "-100", "50", "0.5")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numeric_text_with_and_without_ansi(spark, ansi):
    """Both sides of the smallest amount that a cast writes without an exponent, and the ends of the range."""
    values = ["0", "0.0000001", "-0.000000999", "0.000001", "-0.000001", "0.000001001", "10", "-123456789012345.123456789", None]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(v,) for v in values], "v string")
        assert [r[0] for r in df.select(numeric_text(numeric(F.col("v")))).collect()] == values
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_quotient_keeps_nine_decimals(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(24,9)) a, CAST(7 AS DECIMAL(24,9)) b")
    assert str(df.select(in_euros(F.col("a"), F.col("b"))).first()[0]) == "0.214285714"


def test_zero_rate(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(24,9)) a, CAST(0 AS DECIMAL(24,9)) b, CAST(NULL AS DECIMAL(24,9)) c")
    assert tuple(df.select(in_euros(F.col("a"), F.col("b"), strict=False), in_euros(F.col("a"), F.col("c"))).first()) == (
        None, None
    )
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(in_euros(F.col("a"), F.col("b"))).collect()


def test_statement_dates(spark):
    df = spark.createDataFrame([("01-02-2025",), ("1-2-2025",)], "d string")
    assert {r[0] for r in df.select(statement_date(F.col("d"))).collect()} == {dt.date(2025, 2, 1)}
    bad = spark.createDataFrame([("31-31-2025",)], "d string")
    assert bad.select(statement_date(F.col("d"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        bad.select(statement_date(F.col("d"))).collect()


def test_delete_keeps_null_matches(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert {r[0] for r in delete_where(df, F.col("x") == "a").collect()} == {"b", None}
