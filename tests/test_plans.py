"""What the optimizer makes of the views: scans, pushed filters, shuffles, joins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF
from fixture import queries
from fixture import tables as t
from tallybook.operators import lookups
from tallybook.plans import costs, workspace
from tallybook.plans.views import VIEWS, build_views, register_views, unregister_views
from tallybook.sources import schemas
from tallybook.sources.tables import Tables, publish, read_export, refresh, store_export
from builders import AS_OF, MONEY, export, maps, payers, same_rows, skus


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored") / "export")
    store_export(t.export(spark, SF), folder)
    return folder


@pytest.fixture(scope="module")
def views(stored):
    return queries.view_queries(lambda s, d: read_export(s, stored, MONEY))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["billing_gcp", "billing_gcp_by_project", "billing_gmp", "sum_costs_month", "support_fee"])
def test_window_prunes_folders_and_reaches_the_scan(spark, views, name):
    plan = plan_of(views[name](spark, SF))
    assert "PartitionFilters: [isnotnull(export_month" in plan
    assert "GreaterThanOrEqual(export_time,1998-09-01" in plan


@pytest.mark.parametrize(
    "name, scans",
    [("billing_gcp", 1), ("billing_gmp", 1), ("sum_costs_month", 1), ("sum_costs_month_by_project", 1),
     ("reseller_invoice", 1), ("support_fee", 1), ("billing_adjustments", 1), ("sum_costs_month_two_scans", 2)],
)
def test_number_of_export_scans(spark, views, name, scans):
    assert plan_of(views[name](spark, SF)).count("FileScan parquet") == scans


@pytest.mark.parametrize(
    "name, shuffles",
    [("billing_gcp", 2), ("billing_gmp", 1), ("sum_costs_month", 2), ("sum_costs_month_by_project", 2),
     ("reseller_invoice", 2), ("billing_adjustments", 0), ("statement_lines", 0)],
)
def test_number_of_shuffles(spark, views, name, shuffles):
    """Two for the two levels of the cost views; the invoice's second one is its final sort."""
    plan = plan_of(views[name](spark, SF))
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") == shuffles


def test_no_python_runs_per_row(spark, views):
    for name, build in views.items():
        plan = plan_of(build(spark, SF))
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_only_needed_nested_fields_are_read(spark, views):
    text = plan_of(views["billing_gmp"](spark, SF))
    assert "system_labels" not in text and "adjustment_info" not in text and "usage" not in text


def test_hot_keys_of_a_big_lookup_join_are_split(spark, monkeypatch):
    """Most rows share one payer and many have none; AQE cuts those partitions on the row side."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        payer = F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 50 == 1, F.concat(F.lit("P"), "id"))
        rows = spark.range(0, 40000, 1, 8).select("id", payer.otherwise("hot").alias("payer_billing_account_id"))
        names = spark.range(200).select(F.concat(F.lit("P"), "id").alias("payer_billing_account_id"), F.lit("x").alias("account_name"))
        df = lookups.with_payer_label(rows, names, small=False)
        assert df.count() == 40000
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_views_by_name(spark, stored, tmp_path):
    places = {"reseller_billing_detailed_export_v1": stored}
    small = {
        "payer_billing_accounts": t.payer_accounts(spark), "sku_third_party": t.sku_third_party(spark),
        "maps_services": t.maps_services(spark), "workspace_sku_sf": t.workspace_skus(spark),
        "billing_accounts": t.contracts(spark), "currency_symbols": t.currency_symbols(spark),
        "importes_lecturas_temp": t.statements_flexible(spark, SF),
        "importes_lecturas_by_project": t.statements_by_project(spark, SF),
        "importes_lecturas_anuales": t.statements_annual(spark, SF),
    }
    for name, df in small.items():
        places[name] = str(tmp_path / name)
        df.write.parquet(places[name])
    tables = Tables(spark, places, money=MONEY)
    names = register_views(tables, t.AS_OF)
    assert len(names) == 14
    counts = {name: spark.sql(f"SELECT count(*) FROM {name}").first()[0] for name in names}
    assert all(counts.values()), counts
    direct = costs.gcp_costs(t.export(spark, SF), *(small[n] for n in ("sku_third_party", "maps_services", "payer_billing_accounts")), t.AS_OF)
    assert same_rows(spark.table("billing_gcp"), direct)
    assert set(build_views(tables, t.AS_OF)) == set(names)
    assert names == VIEWS
    unregister_views(tables)
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_views_follow_their_tables(spark, tmp_path):
    """A reloaded lookup and an export that has grown show without registering again; no broadcast is forced."""
    folder, place = str(tmp_path / "export"), str(tmp_path / "tables")
    store_export(export(spark, {"cost": 5}), folder, table="grown_export")
    lookups_ = {"payer_billing_accounts": payers(spark, ("P1", "old")), "sku_third_party": skus(spark), "maps_services": maps(spark)}
    for name, df in lookups_.items():
        publish(df, f"v_{name}", root=place)
    other = {n: str(tmp_path / n) for n in ("workspace_sku_sf", "billing_accounts", "currency_symbols", "importes_lecturas_temp", "importes_lecturas_by_project", "importes_lecturas_anuales")}
    for name, path in other.items():
        spark.createDataFrame([], schemas.TABLES[name]).write.parquet(path)
    tables = Tables(spark, {**other, **{n: f"v_{n}" for n in lookups_}, "reseller_billing_detailed_export_v1": "grown_export"}, money=MONEY)
    register_views(tables, AS_OF)
    try:
        shown = lambda: [(r.account, int(r.cost_gcp)) for r in spark.sql("SELECT account, cost_gcp FROM billing_gcp").collect()]
        assert shown() == [("old", 5)]
        publish(payers(spark, ("P1", "new")), "v_payer_billing_accounts", root=place)
        assert shown() == [("new", 5)]
        store_export(export(spark, {"cost": 7}), folder, mode="append", table="grown_export")
        assert shown() == [("new", 12)]
        store_export(export(spark, {"cost": 1}), folder, mode="months", table="grown_export")
        assert shown() == [("new", 1)]
        export(spark, {"cost": 2}).withColumn("export_month", F.trunc("export_time", "month")).write.mode("append").partitionBy("export_month").parquet(folder)
        refresh(spark)
        assert shown() == [("new", 3)]
        assert "ResolvedHint" not in spark.table("billing_gcp")._jdf.queryExecution().analyzed().toString()
    finally:
        unregister_views(tables)
        for name in ("grown_export", *(f"v_{n}" for n in lookups_)):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_views_of_two_sessions_follow_their_tables(spark, tmp_path):
    """A session that registers its own views doesn't take the other's from the rebuild, in either order."""
    place = str(tmp_path / "tables")
    publish(payers(spark, ("P1", "old")), "two_payers", root=place)
    paths = {n: str(tmp_path / n) for n in schemas.TABLES if n != "payer_billing_accounts"}
    for name, path in paths.items():
        frame = export(spark, {"cost": 5}) if name.endswith("export_v1") else spark.createDataFrame([], schemas.TABLES[name])
        frame.write.parquet(path)
    sessions = [spark, spark.newSession()]
    sides = [Tables(s, {**paths, "payer_billing_accounts": "two_payers"}, money=MONEY) for s in sessions]
    shown = lambda: [[r.account for r in s.sql("SELECT account FROM billing_gcp").collect()] for s in sessions]
    try:
        for tables in sides:
            register_views(tables, AS_OF)
        assert shown() == [["old"], ["old"]]
        for s, account in zip(sessions, ("first", "second")):
            publish(payers(s, ("P1", account)), "two_payers", root=place)
            assert shown() == [[account], [account]]
        unregister_views(sides[1])
        publish(payers(spark, ("P1", "last")), "two_payers", root=place)
        assert [r.account for r in spark.sql("SELECT account FROM billing_gcp").collect()] == ["last"]
    finally:
        for tables in sides:
            unregister_views(tables)
        spark.sql("DROP TABLE IF EXISTS two_payers")


def test_catalog_export_lists_the_window_only(spark, stored, tmp_path):
    store_export(t.export(spark, SF), str(tmp_path / "export"), table="listed_export")
    try:
        df = costs.gmp_costs(read_export(spark, "listed_export", MONEY), t.maps_services(spark), t.payer_accounts(spark), t.AS_OF)
        scan = df._jdf.queryExecution().sparkPlan().toString()
        assert "CatalogFileIndex" in scan or "PartitionFilters: [isnotnull(export_month" in scan
        whole = spark.table("listed_export").count()
        window = spark.table("listed_export").filter("export_month >= DATE '1998-09-01'")
        assert 0 < window.count() < whole and same_rows(df, costs.gmp_costs(t.export(spark, SF), t.maps_services(spark), t.payer_accounts(spark), t.AS_OF))
    finally:
        spark.sql("DROP TABLE listed_export")


@pytest.mark.parametrize("stage, scans", [(None, 1), (workspace.written_once, 0)])
def test_scans_of_the_licence_view(spark, stored, stage, scans):
    """As users get it: the export is scanned once without a stage, and by none but the stage itself with one."""
    df = workspace.workspace_charges(read_export(spark, stored, MONEY), t.workspace_skus(spark), t.AS_OF, stage=stage)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("PartitionFilters: [isnotnull(export_month") == scans
    assert stage or final.count("ReusedExchange") >= 2


def test_rows_out_of_the_shared_shuffle(spark):
    """Repeated rows, NULLs and negative zeros come back as often as they went in."""
    rows = [("a", 1.5, None, "d", "s")] * 3 + [(None, None, None, None, None)] * 2 + [("b", 0.0, "x", None, "s")]
    frame = spark.createDataFrame(rows, "usage_type string, n double, invoice_month string, domain_name string, sku_id string")
    assert sorted(map(tuple, workspace.grouped_once(frame).collect()), key=repr) == sorted(rows, key=repr)


def test_equal_label_arrays_are_read_once(spark):
    """The smallest texts need a sort; hashing has left one row for each array by then."""
    plan = plan_of(queries.single()["label_attributes"](spark, SF))
    assert plan.index("SortAggregate") < plan.index("HashAggregate(keys=[system_labels")


def test_seat_changes_and_commitments_share_a_scan(spark):
    df = queries.single()["j_seat_change_exists"](spark, SF)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("ReadSchema: struct<l_orderkey") == 1 and "ReusedExchange" in final
    assert final.count("transform(") == 1  # the labels are read once, above the join


def test_shared_shuffle_needs_no_sort(spark):
    frame = spark.range(9).selectExpr("cast(id AS string) AS usage_type", "id AS n", *[f"'x' AS {k}" for k in workspace.SEAT_KEYS])
    assert "Sort" not in plan_of(workspace.grouped_once(frame))
    sums = workspace.grouped_once(frame, {"n": F.sum("n"), "rows": F.count(F.lit(1))})
    assert "Sort" not in plan_of(sums) and sums.agg(F.sum("n"), F.sum("rows")).first() == (36, 9)


def test_order_of_the_invoice_and_the_fees(spark, views):
    months = [r.invoice_month for r in views["reseller_invoice"](spark, SF).collect()]
    assert len(months) > 20 and months == sorted(months, key=lambda m: m or "", reverse=True)
    months = [r.invoice_month for r in views["support_fee"](spark, SF).collect()]
    assert len(months) > 5 and months == sorted(months, key=lambda m: m or "")
