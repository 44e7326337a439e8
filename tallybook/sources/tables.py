"""Readers, literal and empty relations, the stored export, and tables whose content is replaced as a whole."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, StructField, StructType

from ..operators.filters import PARTITIONS
from .schemas import TABLES, export_schema


SHEET_OPTIONS = {"header": True, "enforceSchema": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST"}
#: Tables that users edit as files outside Spark.
SHEETS = {"ext_workspace_sku_sf"}


class Tables:
    """Logical table names mapped to where they are: a catalog table, or a path (anything with a slash).

    Names without an entry are looked up in the catalog under ``namespace``, or as they are.
    """

    def __init__(
        self,
        spark: SparkSession,
        locations: Mapping[str, str] | None = None,
        *,
        namespace: str | None = None,
        money: DataType | None = None,
    ):
        self.spark = spark
        self.locations = dict(locations or {})
        self.namespace = namespace
        self.money = money or DoubleType()

    def location(self, name: str) -> str:
        if name in self.locations:
            return self.locations[name]
        return f"{self.namespace}.{name}" if self.namespace and "." not in name else name

    def read(self, name: str) -> DataFrame:
        """The table with its declared columns; files are read by schema, so other columns stay on disk."""
        schema = TABLES[name]
        if name == "reseller_billing_detailed_export_v1":
            return read_export(self.spark, self.location(name), self.money)
        where = self.location(name)
        if "/" not in where:
            if name in SHEETS:
                self.spark.catalog.refreshTable(where)
            return declared_columns(self.spark.table(where), schema)
        if where.endswith(".csv"):
            return read_sheet_csv(self.spark, where, schema)
        return self.spark.read.schema(schema).parquet(where)


def read_export(spark: SparkSession, where: str, money: DataType | None = None) -> DataFrame:
    """The billing export from a catalog table or a parquet folder.

    The explicit schema names only the nested fields the views use. A folder written by :func:`store_export` also
    gives its partition column.
    """
    schema = export_schema(money or DoubleType())
    if "/" not in where:
        table = spark.table(where)
        extra = [StructField(name, DateType()) for name in PARTITIONS if name in table.columns]
        return declared_columns(table, StructType([*schema.fields, *extra]))
    return spark.read.schema(schema).parquet(where)


def declared_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in the declared order and types, whatever else the table holds. A missing one fails."""
    return df.select(*[
        F.col(f"`{f.name}`") if df.schema[f.name].dataType == f.dataType else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def store_export(export: DataFrame, folder: str, *, by: str = "month", mode: str = "error", table: str | None = None) -> None:
    """Write the export partitioned by export month (or ``by="day"``), so that windowed views read only what they need.

    Reading the folder by its path first lists all of its files. With ``table`` the partitions are kept in the catalog
    under that name, and a windowed view lists the folders of its window only. ``mode="months"`` replaces the months
    that these rows have and leaves the others alone.

    The window always starts with a month, so months prune as well as days and make fewer files. The rebalance hint
    lets the adaptive planner cut big partitions into several files and pack small ones.
    """
    name, value = {
        "month": ("export_month", F.trunc("export_time", "month")),
        "day": ("export_date", F.to_date("export_time")),
    }[by]
    rows = export.drop(*PARTITIONS).withColumn(name, value).hint("rebalance", name)
    writer = rows.write.option("partitionOverwriteMode", "dynamic" if mode == "months" else "static")
    writer.mode("overwrite" if mode == "months" else mode).partitionBy(name).parquet(folder)
    spark = export.sparkSession
    if table:
        if not spark.catalog.tableExists(table):
            columns = ", ".join(_column(f) for f in rows.schema.fields)
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{name}`) LOCATION {_quoted(folder)}")
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
    refresh(spark)


def read_sheet_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A spreadsheet exported as CSV: one header row skipped, columns by position, nothing inferred.

    Quotes are doubled within quotes, cells may hold line breaks, a backslash is an ordinary character, and a row with
    too few or too many cells fails the read.
    """
    return spark.read.schema(schema).options(**SHEET_OPTIONS).csv(path)


def attach_sheet(spark: SparkSession, path: str, table: str, schema: StructType) -> None:
    """Make a spreadsheet exported as CSV an external catalog table with the declared columns, by position.

    Nothing is copied. ``Tables.read`` lists the file anew each time; plain SQL needs ``REFRESH TABLE`` after a change
    of the file, as for any external table. A table of that name must not exist.
    """
    columns = ", ".join(_column(f) for f in schema.fields)
    options = ", ".join(f"{_quoted(k)} {_quoted(str(v).lower() if v is True else v)}" for k, v in SHEET_OPTIONS.items())
    spark.sql(f"CREATE TABLE {table} ({columns}) USING csv OPTIONS ({options}) LOCATION {_quoted(path)}")


def literal(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A small relation from values of the caller's configuration, held in the plan itself with its true size."""
    columns = [pa.array([row[i] for row in rows]) for i in range(len(schema))]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A relation with the declared columns and no row."""
    return spark.createDataFrame([], schema)


def check_required(df: DataFrame, schema: StructType) -> DataFrame:
    """Fail the job that reads these rows when a required column is NULL."""

    def checked(name: str):
        missing = F.raise_error(F.lit(f"column {name} must not be NULL"))
        return F.when(F.col(name).isNull(), missing.cast(schema[name].dataType)).otherwise(F.col(name)).alias(name)

    return df.select(*[checked(f.name) if not f.nullable else F.col(f.name) for f in schema.fields])


def publish(
    df: DataFrame,
    table: str,
    *,
    root: str | None = None,
    partition_by: Sequence[str] = (),
    schema: StructType | None = None,
) -> DataFrame:
    """Replace the content of a catalog table by these rows.

    The rows go to a folder of their own and the table is pointed at it once the write is complete; the rows may come
    from the table itself, and a failed write changes nothing. An unpartitioned table that keeps its columns switches
    in one step. With partitions or other columns the catalog entry is dropped and made again, so a reader in between
    finds no table; its rows are safe in either folder.

    The table gets the columns that ``schema`` or else ``df`` declares: their types (also of partition columns, which
    are not guessed from folder names) and comments. A NULL in a required column fails the write; Spark's own catalog
    doesn't keep NOT NULL, so the declaration stays with ``schemas``. New folders lie under ``root``, or beside the table's present folder, or in the warehouse. Old folders are kept for
    running readers; :func:`clear_old` removes them.
    """
    spark = df.sparkSession
    name = table.replace("`", "")
    declared = schema or df.schema
    exists = spark.catalog.tableExists(table)
    folder = f"{_root(spark, table, name, root, exists)}/{uuid.uuid4().hex}"
    check_required(df, declared).write.partitionBy(*partition_by).parquet(folder)
    if exists and not partition_by and _same_columns(spark.table(table).schema, declared) and not _partitions(spark, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(folder)}")
    else:
        columns = ", ".join(_column(f) for f in declared.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts} LOCATION {_quoted(folder)}")
        if partition_by:
            spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    refresh(spark)
    return spark.table(table)


#: What brings registered views up to date, by application and session; see ``plans.views``.
REFRESHERS: dict[tuple[str, str], Callable[[], object]] = {}


def session_key(spark: SparkSession) -> tuple[str, str]:
    return spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID()


def refresh(spark: SparkSession) -> None:
    """Rebuild the views registered in any session of this application, after a table has changed."""
    application, _ = session_key(spark)
    for key, refresher in list(REFRESHERS.items()):
        if key[0] == application:
            refresher()


def clear_old(spark: SparkSession, table: str) -> int:
    """Remove the table's former folders, which lie beside the present one; returns how many. No reader may use them.

    A folder that isn't complete may belong to a ``publish`` that is still writing: it is spared for a day.
    """
    present = _location(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path(present)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in store.listStatus(path.getParent()) if f.isDirectory() and f.getPath().getName() != path.getName()]
    # only folders that publish() names; anything else beside them is not ours
    old = [p for p in old if len(p.getName()) == 32 and set(p.getName()) <= set("0123456789abcdef")]
    young = (time.time() - 24 * 3600) * 1000
    complete = lambda p: store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    old = [p for p in old if complete(p) or store.getFileStatus(p).getModificationTime() < young]
    for one in old:
        store.delete(one, True)
    return len(old)


def _root(spark: SparkSession, table: str, name: str, root: str | None, exists: bool) -> str:
    if root:
        return f"{root.rstrip('/')}/{name}"
    if exists and (place := _location(spark, table)).rsplit("/", 2)[-2] == name:
        return place.rsplit("/", 1)[0]
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/published/{name}"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name}


def _location(spark: SparkSession, table: str) -> str:
    return _details(spark, table)["Location"].rstrip("/")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(field: StructField) -> str:
    comment = f" COMMENT {_quoted(field.metadata['comment'])}" if field.metadata.get("comment") else ""
    return f"`{field.name}` {field.dataType.simpleString()}{comment}"


def _same_columns(a: StructType, b: StructType) -> bool:
    kept = lambda t: [(f.name, f.dataType, f.metadata.get("comment")) for f in t.fields]
    return kept(a) == kept(b)
