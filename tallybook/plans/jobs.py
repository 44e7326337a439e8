"""Upkeep jobs: truncate-and-load copies, lookup loads from configuration, and the month purge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.filters import delete_where
from ..sources.schemas import TABLES
from ..sources.tables import _quoted, check_required, literal, publish, refresh

MONTHLY_STATEMENTS = ["importes_lecturas_temp", "importes_lecturas_by_project", "importes_lecturas_anuales"]
WORKSPACE_STATEMENTS = "importes_lecturas_workspace"


def refresh_copy(source: DataFrame, target: str, *, root: str | None = None, enabled: bool = True) -> DataFrame | None:
    """Replace the target by a full copy of the source. A copy that is not enabled does nothing.

    A target of the declared tables gets its declared columns, as far as the source has just these.
    """
    if not enabled:
        return None
    schema = TABLES.get(target.replace("`", "").rsplit(".", 1)[-1])
    same = schema and [(f.name, f.dataType) for f in schema.fields] == [(f.name, f.dataType) for f in source.schema.fields]
    return publish(source.select("*"), target, root=root, schema=schema if same else None)


def load_lookup(
    spark: SparkSession, entries: Mapping[str, str], schema: StructType, target: str, *, root: str | None = None
) -> bool:
    """Load a two-column lookup from configuration; returns whether it was written.

    An empty mapping leaves the table alone, and so does one equal to what the table already holds.
    """
    if not entries:
        return False
    wanted = check_required(literal(spark, list(entries.items()), schema), schema)
    if spark.catalog.tableExists(target):
        held = spark.table(target)
        if held.columns == wanted.columns:
            changed = wanted.exceptAll(held).unionAll(held.exceptAll(wanted))
            if changed.isEmpty():
                return False
    publish(wanted, target, root=root, schema=schema)
    return True


def purge(spark: SparkSession, table: str, values: Mapping[str, str], *, root: str | None = None) -> None:
    """Delete the rows whose columns equal all these values; rows with a NULL there stay.

    On a table partitioned by exactly these text columns the partition's files are overwritten by nothing, which
    removes them for good, and the partition is dropped; no other row is touched. Otherwise the surviving rows are
    published in place of the old ones. Rows that are left all the same are an error.
    """
    columns = spark.catalog.listColumns(table)
    partition = [c.name for c in columns if c.isPartition]
    condition: Column = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == F.lit(value))
    if spark.table(table).filter(condition).isEmpty():
        return
    if sorted(partition) == sorted(values) and all(c.dataType == "string" for c in columns if c.isPartition):
        spec = ", ".join(f"`{name}` = {_quoted(value)}" for name, value in values.items())
        nothing = ", ".join(f"CAST(NULL AS {c.dataType})" for c in columns if not c.isPartition)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {nothing} WHERE false")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        spark.catalog.refreshTable(table)
        refresh(spark)
    else:
        publish(
            delete_where(spark.table(table), condition), table, root=root, partition_by=partition, schema=spark.table(table).schema
        )
    if not spark.table(table).filter(condition).isEmpty():
        raise RuntimeError(f"rows of {dict(values)} are still in {table}")


def purge_month(
    spark: SparkSession,
    year: str,
    month: str,
    *,
    monthly: Sequence[str] = MONTHLY_STATEMENTS,
    workspace: str | None = WORKSPACE_STATEMENTS,
    root: str | None = None,
    journal: str | None = None,
) -> None:
    """Delete one month (``YYYY``, ``MM``) from the statement tables, one table after the other.

    Each purge can be repeated, so an interrupted one ends right when it is run again. With ``journal``, a folder all
    drivers see, it then goes on with the first table that wasn't finished and doesn't read the others again. Once all
    are done the month's marks are removed, so a later purge of the month starts afresh.
    """
    if not (len(year) == 4 and len(month) == 2 and (year + month).isdigit() and "01" <= month <= "12"):
        raise ValueError("give the year as YYYY and the month as MM")
    steps = [(table, {"invoice_month": year + month}) for table in monthly]
    if workspace:
        steps.append((workspace, {"Anyo__c": year, "Mes__c": month}))
    if journal is None:
        for table, values in steps:
            purge(spark, table, values, root=root)
        return
    path = spark._jvm.org.apache.hadoop.fs.Path
    marks = path(f"{journal.rstrip('/')}/purge-{year}{month}")
    store = marks.getFileSystem(spark._jsc.hadoopConfiguration())
    for table, values in steps:
        mark = path(marks, table.replace("`", ""))
        if not store.exists(mark):
            purge(spark, table, values, root=root)
            store.create(mark, True).close()
    store.delete(marks, True)
