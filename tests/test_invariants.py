"""Relations that hold for any input, on seeded random exports."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from builders import AS_OF, export, licences, maps, payers, same_rows, skus
from tallybook.operators import lookups
from tallybook.plans import costs, invoice, workspace

SERVICES = ["BigQuery", "Places API", "Compute Engine", "Invoice", "Reseller Program", "Custom", None, "Support"]

pytestmark = pytest.mark.usefixtures("interpreted")


def random_rows(seed: int, n: int) -> list[dict]:
    pick = random.Random(seed)
    kinds = ["RESELLER_MARGIN", "RESELLERxMARGIN", "PROMOTION", None]
    uses = ["FLEXIBLE_SEATS_ITEM", "COMMITMENT_MONTHLY_ITEM", "COMMITMENT_SEATS_CHANGE_ITEM", "OTHER"]

    def row() -> dict:
        amounts = [(pick.choice(kinds), pick.choice([-2, -1, 1, 2])) for _ in range(pick.randrange(4))]
        labels = [("x/usage_type", pick.choice(uses)), ("domain_name", pick.choice(["d", "e", None]))]
        return {
            "account": pick.choice(["A-B-C", "A-B-D", "bad"]),
            "payer": pick.choice(["P1", "P2", None]),
            "month": pick.choice(["202503", "202504"]),
            "service": pick.choice(SERVICES),
            "sku_id": pick.choice(["K1", "K2"]),
            "sku": pick.choice(["a", "b", None, "GCP Partner-led Enhanced Support Variable Fee"]),
            "project": pick.choice(["p", "q", None]),
            "cost": pick.choice([0, 1, -3, 7]),
            "customer_cost": pick.choice([None, 2, 5]),
            "credits": pick.choice([None, amounts]),
            "transaction_type": pick.choice(["GOOGLE", "THIRD_PARTY_AGENCY", None]),
            "seller": pick.choice(["s", None]),
            "labels": pick.choice([None, labels]),
            "export_time": dt.datetime(2025, pick.choice([1, 3, 5]), 10),
        }

    return [row() for _ in range(n)]


@pytest.fixture(scope="module", params=[1])
def inputs(spark, request):
    df = export(spark, *random_rows(request.param, 300))
    return df, skus(spark, "K2", "K2"), maps(spark, "Custom", "Custom"), payers(spark, ("P1", "one"), ("P1", "uno"))


def test_one_scan_equals_two(inputs):
    e, s, m, p = inputs
    two = costs.monthly_costs(costs.gmp_costs(e, m, p, AS_OF), costs.gcp_costs(e, s, m, p, AS_OF))
    assert same_rows(costs.monthly_costs_one_scan(e, s, m, p, AS_OF), two)


@pytest.mark.parametrize("parity", [True, False])
def test_one_scan_equals_two_by_project(inputs, parity):
    e, s, m, p = inputs
    left = costs.gmp_costs_by_project(e, s, m, p, AS_OF, parity=parity)
    two = costs.monthly_costs_by_project(left, costs.gcp_costs_by_project(e, s, m, p, AS_OF))
    assert same_rows(costs.monthly_costs_by_project_one_scan(e, s, m, p, AS_OF, parity=parity), two)


def test_parity_project_view_doubles_the_base_amounts(inputs):
    e, s, m, p = inputs
    once = costs.gcp_costs_by_project(e, s, m, p, AS_OF).agg(F.sum("cost_gcp"), F.sum("cost_thirdparty")).first()
    both = costs.monthly_costs_by_project_one_scan(e, s, m, p, AS_OF)
    twice = both.agg(F.sum("cost_gcp"), F.sum("cost_thirdparty")).first()
    assert (twice[0], twice[1]) == (once[0] * 2, once[1])


def test_partitioning_and_order_do_not_matter(inputs):
    e, s, m, p = inputs
    shuffled = e.orderBy(F.desc("cost")).repartition(7)
    assert same_rows(costs.gcp_costs(e, s, m, p, AS_OF), costs.gcp_costs(shuffled, s, m, p, AS_OF))


@pytest.mark.parametrize(
    "view",
    [
        lambda s, e, k, m, p: costs.gcp_costs(e, k, m, p, AS_OF),
        lambda s, e, k, m, p: costs.gcp_costs_by_project(e, k, m, p, AS_OF, marketplace=True),
        lambda s, e, k, m, p: costs.gmp_costs(e, m, p, AS_OF),
        lambda s, e, k, m, p: costs.gmp_costs_by_project(e, k, m, p, AS_OF, parity=False),
        lambda s, e, k, m, p: costs.monthly_costs_one_scan(e, k, m, p, AS_OF),
        lambda s, e, k, m, p: invoice.reseller_invoice(e, p),
        lambda s, e, k, m, p: workspace.workspace_charges(e, licences(s, "K1"), AS_OF, stage=workspace.written_once),
    ],
    ids=["cloud", "cloud-project", "maps", "maps-project", "monthly", "invoice", "workspace"],
)
def test_lookups_too_big_to_broadcast_give_the_same_rows(spark, inputs, monkeypatch, view):
    e, k, m, p = inputs
    small = view(spark, e, k, m, p)
    monkeypatch.setattr(lookups, "MAX_ROWS", 0)
    big = view(spark, e, k, m, p)
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert same_rows(small, big)


def test_doubles_work_as_amounts(spark):
    rows = [{"cost": 1, "credits": [("RESELLER_MARGIN", -2)]}, {"cost": 2, "project": None}]
    df = export(spark, *rows)
    doubled = df.withColumns(
        {
            "cost": F.col("cost").cast("double"),
            "customer_cost": F.col("customer_cost").cast("double"),
            "credits": F.col("credits").cast("array<struct<type:string,amount:double>>"),
        }
    )
    lookup = (skus(spark), maps(spark), payers(spark))
    got = costs.monthly_costs_one_scan(doubled, *lookup, AS_OF)
    assert dict(got.dtypes)["cost_gmp"] == dict(got.dtypes)["cost_gcp"] == "double"
    assert same_rows(got, costs.monthly_costs_one_scan(df, *lookup, AS_OF))


@pytest.fixture(scope="module", params=[11, 12])
def doubles(spark, request):
    """Amounts with many decimals, which floating sums would add differently in every order."""
    df = export(spark, *random_rows(request.param, 300))
    factor = F.lit(0.1) / 3
    return df.withColumns({
        "cost": F.col("cost") * factor,
        "customer_cost": F.col("customer_cost") * factor,
        "credits": F.transform("credits", lambda c: F.struct(c["type"].alias("type"), (c["amount"] * factor).alias("amount"))),
    })


@pytest.mark.parametrize("plan", [costs.gcp_costs, costs.gcp_costs_by_project, costs.monthly_costs_one_scan])
def test_doubles_give_one_answer_for_every_plan(spark, doubles, monkeypatch, plan):
    lookup = (skus(spark, "K2", "K2"), maps(spark, "Custom"), payers(spark, ("P1", "one"), ("P1", "uno")))
    key = lambda df: sorted(map(repr, df.collect()))
    want = key(plan(doubles, *lookup, AS_OF))
    for frame in (doubles.repartition(7), doubles.orderBy(F.desc("cost")).coalesce(1)):
        assert key(plan(frame, *lookup, AS_OF)) == want
    monkeypatch.setattr(lookups, "MAX_ROWS", 1)  # the maps list is small, the others are not
    assert key(plan(doubles, *lookup, AS_OF)) == want
    monkeypatch.setattr(lookups, "MAX_ROWS", 0)
    assert key(plan(doubles, *lookup, AS_OF)) == want


def test_a_margin_that_is_zero_in_decimals_is_zero(spark, monkeypatch):
    """Three lines of one group without project, with margins that sum to nothing, but not in floating numbers."""
    rows = [{"project": None, "sku_id": k, "credits": [("RESELLER_MARGIN", m)]} for k, m in (("K1", -0.9), ("K3", 0.1), ("K1", 0.8))]
    df = export(spark, *rows)
    df = df.withColumns({"cost": F.col("cost").cast("double"), "customer_cost": F.col("customer_cost").cast("double"),
                         "credits": F.col("credits").cast("array<struct<type:string,amount:double>>")})
    for most in (10, 0):
        monkeypatch.setattr(lookups, "MAX_ROWS", most)
        (got,) = costs.gcp_costs(df, skus(spark), maps(spark), payers(spark), AS_OF).collect()
        assert (got.cost_gcp, got.cost_base_thirdparty, got.reseller_margin_gcp) == (0, 30, 0)
