from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from tallybook.plans import jobs
from tallybook.session import fresh_folder, shared_folder
from tallybook.sources import schemas
from tallybook.sources.tables import (
    Tables,
    attach_sheet,
    check_required,
    clear_old,
    empty,
    literal,
    publish,
    read_export,
    read_sheet_csv,
    store_export,
)
from builders import MONEY, export


@pytest.fixture
def name(spark, request):
    table = f"t_{abs(hash(request.node.name))}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def values(spark, table):
    return sorted(spark.table(table).collect())


def test_copy_replaces_and_repeats(spark, name, root):
    first = literal(spark, [("a",), ("b",)], schemas.MAPS_SERVICES)
    jobs.refresh_copy(first, name, root=root)
    jobs.refresh_copy(first, name, root=root)
    assert values(spark, name) == [("a",), ("b",)]
    jobs.refresh_copy(literal(spark, [("c",)], schemas.MAPS_SERVICES), name, root=root)
    assert values(spark, name) == [("c",)]
    assert jobs.refresh_copy(first, name, root=root, enabled=False) is None
    assert values(spark, name) == [("c",)]


def test_copy_takes_over_another_schema(spark, name, root):
    jobs.refresh_copy(literal(spark, [("a",)], schemas.MAPS_SERVICES), name, root=root)
    jobs.refresh_copy(literal(spark, [("P", "n")], schemas.PAYER_ACCOUNTS), name, root=root)
    assert values(spark, name) == [("P", "n")]


def test_table_can_be_replaced_from_itself_and_a_failed_write_changes_nothing(spark, name, root):
    publish(spark.range(3).toDF("x"), name, root=root)
    publish(spark.table(name).filter("x > 0"), name, root=root)
    assert values(spark, name) == [(1,), (2,)]
    broken = spark.table(name).select((F.col("x") / (F.col("x") - 1)).alias("x"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish(broken, name, root=root)
    assert values(spark, name) == [(1,), (2,)]


def test_lookup_load(spark, name, root):
    def load(entries):
        return jobs.load_lookup(spark, entries, schemas.PAYER_ACCOUNTS, name, root=root)

    assert load({}) is False and not spark.catalog.tableExists(name)
    assert load({"P1": "O'Neill \"x\"", "P2": "b"}) is True
    assert load({"P2": "b", "P1": "O'Neill \"x\""}) is False
    assert values(spark, name) == [("P1", "O'Neill \"x\""), ("P2", "b")]
    assert load({"P2": "c"}) is True
    assert values(spark, name) == [("P2", "c")]


def test_required_columns_are_checked(spark):
    rows = spark.createDataFrame([("P1", None)], "payer_billing_account_id string, account_name string")
    with pytest.raises(Exception, match="account_name must not be NULL"):
        check_required(rows, schemas.PAYER_ACCOUNTS).collect()


@pytest.mark.parametrize("partition", [[], ["invoice_month"]])
def test_purge(spark, name, root, partition):
    rows = spark.createDataFrame(
        [(1, "202501"), (2, "202502"), (3, None)], "amount int, invoice_month string"
    )
    publish(rows, name, root=root, partition_by=partition)
    jobs.purge_month(spark, "2025", "01", monthly=[name], workspace=None, root=root)
    assert {r["amount"] for r in spark.table(name).collect()} == {2, 3}
    jobs.purge_month(spark, "2025", "01", monthly=[name], workspace=None, root=root)
    assert spark.table(name).count() == 2


def test_purge_by_year_and_month(spark, name, root):
    rows = spark.createDataFrame(
        [("2025", "01"), ("2025", "02"), ("2024", "01"), (None, "01"), ("2025", None)], "Anyo__c string, Mes__c string"
    )
    publish(rows, name, root=root)
    jobs.purge_month(spark, "2025", "01", monthly=[], workspace=name, root=root)
    assert spark.table(name).count() == 4


def test_an_interrupted_purge_goes_on_where_it_stopped(spark, name, root, monkeypatch):
    tables = [f"{name}_{i}" for i in range(3)]
    rows = spark.createDataFrame([(1, "202501"), (2, "202502")], "amount int, invoice_month string")
    done, purge = [], jobs.purge

    def run(stop_at=None):
        def watched(spark, table, values, *, root=None):
            if table == stop_at:
                raise RuntimeError("lost")
            purge(spark, table, values, root=root)
            done.append(table)

        monkeypatch.setattr(jobs, "purge", watched)
        jobs.purge_month(spark, "2025", "01", monthly=tables, workspace=None, root=root, journal=f"{root}/journal")

    try:
        for table in tables:
            publish(rows, table, root=root)
        with pytest.raises(RuntimeError, match="lost"):
            run(stop_at=tables[1])
        assert [spark.table(t).count() for t in tables] == [1, 2, 2]
        run()
        assert done == tables and [values(spark, t) for t in tables] == [[(2, "202502")]] * 3
        publish(rows, tables[0], root=root)
        run()
        assert values(spark, tables[0]) == [(2, "202502")]
    finally:
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_text_partitions_stay_text_and_a_purge_removes_their_files(spark, name, root):
    rows = spark.createDataFrame(
        [(1, "2025", "01"), (2, "2025", "02"), (3, "2024", "01"), (4, None, "01")], "amount int, Anyo__c string, Mes__c string"
    )
    publish(rows, name, root=root, partition_by=["Anyo__c", "Mes__c"])
    assert dict(spark.table(name).dtypes) == {"amount": "int", "Anyo__c": "string", "Mes__c": "string"}
    jobs.purge_month(spark, "2025", "01", monthly=[], workspace=name, root=root)
    assert {r.amount for r in spark.table(name).collect()} == {2, 3, 4}
    spark.catalog.recoverPartitions(name)
    assert {r.amount for r in spark.table(name).collect()} == {2, 3, 4}
    jobs.purge_month(spark, "2025", "03", monthly=[], workspace=name, root=root)
    assert spark.table(name).count() == 3


def test_purge_keeps_types_of_a_table_partitioned_otherwise(spark, name, root):
    spark.sql(f"CREATE TABLE {name} (amount INT NOT NULL COMMENT 'how much', Anyo__c STRING, Mes__c STRING) USING parquet PARTITIONED BY (Mes__c)")
    spark.sql(f"INSERT INTO {name} VALUES (1, '2025', '01'), (2, '2025', '02')")
    jobs.purge_month(spark, "2025", "01", monthly=[], workspace=name, root=root)
    assert values(spark, name) == [(2, "2025", "02")]
    (column,) = [c for c in spark.catalog.listColumns(name) if c.name == "amount"]
    assert dict(spark.table(name).dtypes)["Mes__c"] == "string" and column.description == "how much"


def test_stored_lookups_keep_comments_and_refuse_missing_values(spark, name, root):
    for entries in ({"P1": "a"}, {"P1": "b"}):
        jobs.load_lookup(spark, entries, schemas.PAYER_ACCOUNTS, name, root=root)
        columns = {c.name: c for c in spark.catalog.listColumns(name)}
        for field in schemas.PAYER_ACCOUNTS.fields:
            assert (columns[field.name].description or None) == field.metadata.get("comment")
    bad = spark.createDataFrame([(None, "x")], "payer_billing_account_id string, account_name string")
    with pytest.raises(Exception, match="must not be NULL"):
        publish(bad, name, root=root, schema=schemas.PAYER_ACCOUNTS)
    assert values(spark, name) == [("P1", "b")]


def test_permanent_tables_lie_in_the_warehouse_and_old_folders_can_go(spark, name, root):
    publish(spark.range(2).toDF("x"), name)
    place = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location"][0]
    assert "spark-warehouse" in place and shared_folder(spark) not in place
    publish(spark.range(3).toDF("x"), name)
    publish(spark.range(4).toDF("x"), name)
    assert clear_old(spark, name) == 2 and clear_old(spark, name) == 0
    place = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location"][0]
    writing = os.path.join(os.path.dirname(place.removeprefix("file:")), "0" * 32)
    os.makedirs(writing)
    assert clear_old(spark, name) == 0 and os.path.isdir(writing)
    os.utime(writing, (0, 0))
    assert clear_old(spark, name) == 1 and not os.path.isdir(writing)
    assert spark.table(name).count() == 4


def test_catalog_reads_give_the_declared_columns(spark, name):
    spark.createDataFrame([(1, "n", "K")], "extra int, sku_name string, sku_id string").write.saveAsTable(name)
    assert Tables(spark, {"sku_third_party": name}).read("sku_third_party").collect() == [("K",)]
    spark.sql(f"DROP TABLE {name}")
    spark.createDataFrame([(7,)], "sku int").write.saveAsTable(name)
    assert Tables(spark, {"maps_services": name}).read("maps_services").collect() == [("7",)]


@pytest.mark.parametrize("year, month", [("25", "01"), ("2025", "1"), ("2025", "13"), ("2025", "x1")])
def test_purge_rejects_malformed_months(spark, year, month):
    with pytest.raises(ValueError):
        jobs.purge_month(spark, year, month, monthly=[])


def test_sheet_skips_one_header_row_and_keeps_text(spark, root):
    path = f"{root}/sheet.csv"
    with open(path, "w") as f:
        f.write("any,header,at,all,is,fine\nK1,007,,S,\"a, b\",x\n")
    (row,) = read_sheet_csv(spark, path, schemas.WORKSPACE_SKUS).collect()
    assert tuple(row) == ("K1", "007", None, "S", "a, b", "x")


def test_sheet_with_quotes_line_breaks_and_backslashes(spark, root):
    rows = [["K1", '5" screen, x', "two\nlines", "ends in \\", "", 'a "b" c'], ["K2", "\\", '"', ",", "é", "\\n"]]
    with open(f"{root}/sheet.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerows([["h"] * 6, *rows])
    got = read_sheet_csv(spark, f"{root}/sheet.csv", schemas.WORKSPACE_SKUS).collect()
    assert [[v or "" for v in r] for r in got] == rows


def test_a_malformed_sheet_fails(spark, root):
    with open(f"{root}/sheet.csv", "w") as f:
        f.write("a,b,c,d,e,f\nK1,x,y\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_sheet_csv(spark, f"{root}/sheet.csv", schemas.WORKSPACE_SKUS).collect()


def test_a_sheet_as_catalog_table_is_read_anew(spark, root, name):
    def write(*lines):
        with open(f"{root}/sheet.csv", "w") as f:
            f.write("\n".join(["h1,h2,h3,h4,h5,h6", *lines]) + "\n")

    write("K1,a,b,c,d,\"e\"\"f\"")
    attach_sheet(spark, f"{root}/sheet.csv", name, schemas.WORKSPACE_SKUS)
    tables = Tables(spark, {"ext_workspace_sku_sf": name})
    assert [tuple(r) for r in tables.read("ext_workspace_sku_sf").collect()] == [("K1", "a", "b", "c", "d", 'e"f')]
    copy = f"{name}_copy"
    try:
        jobs.refresh_copy(tables.read("ext_workspace_sku_sf"), copy, root=root)
        write("K1,a longer text,b,c,d,e", "K2,\"two\nlines\",b,c,d,e")
        jobs.refresh_copy(tables.read("ext_workspace_sku_sf"), copy, root=root)
        assert [tuple(r)[:2] for r in values(spark, copy)] == [("K1", "a longer text"), ("K2", "two\nlines")]
        write("K3,x")
        with pytest.raises(Exception, match="(?i)malformed"):
            jobs.refresh_copy(tables.read("ext_workspace_sku_sf"), copy, root=root)
        assert spark.table(copy).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {copy}")


def test_empty_relation_has_the_declared_columns(spark):
    for schema in schemas.TABLES.values():
        df = empty(spark, schema)
        assert df.columns == schema.names and df.count() == 0


@pytest.mark.parametrize("by, column", [("month", "export_month"), ("day", "export_date")])
def test_export_round_trip(spark, root, by, column):
    df = export(spark, {"credits": [("A", 1)]}, {"labels": [("k", "v")]}, {"export_time": None})
    store_export(df, f"{root}/export", by=by)
    back = read_export(spark, f"{root}/export", MONEY)
    assert dict(back.dtypes)[column] == "date"
    assert sorted(map(repr, back.drop(column).collect())) == sorted(map(repr, df.collect()))


def test_tables_resolve_names_paths_and_sheets(spark, root, name):
    publish(literal(spark, [("a",)], schemas.MAPS_SERVICES), name, root=root)
    with open(f"{root}/skus.csv", "w") as f:
        f.write("h1,h2,h3,h4,h5,h6\nK1,a,b,c,d,e\n")
    tables = Tables(spark, {"maps_services": name, "ext_workspace_sku_sf": f"{root}/skus.csv"}, namespace="billing")
    assert tables.read("maps_services").collect() == [("a",)]
    assert tables.read("ext_workspace_sku_sf").first()["sku_id"] == "K1"
    assert tables.location("currency_symbols") == "billing.currency_symbols"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith("/tmp/")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
