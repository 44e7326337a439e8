"""Row filters of the billing export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import window_start

# Date columns a stored export may be partitioned by: first day of the export's month, or the export's day.
PARTITIONS = ["export_month", "export_date"]


def account_format(export: DataFrame) -> DataFrame:
    """Keep well-formed account ids, such as ``AAAAAA-BBBBBB-CCCCCC``: those LIKE '%-%-%'.

    Looking for a second dash gives the same rows; LIKE with several wildcards would run a regular expression per row.
    """
    account = F.col("billing_account_id")
    return export.filter(F.position(F.lit("-"), account, F.instr(account, "-") + 1) > 0)


def exported_since(export: DataFrame, start: Column) -> DataFrame:
    """Keep rows exported at or after midnight of ``start``.

    The plain comparison equals one on whole days and reaches the file scan. On a stored export its partition column
    is compared too: older folders are not read, and not even listed where the catalog keeps the partitions.
    """
    edges = {"export_month": F.trunc(start, "month"), "export_date": start}
    for name in PARTITIONS:
        if name in export.columns:
            export = export.filter(F.col(name) >= edges[name])
    return export.filter(F.col("export_time") >= start.cast("timestamp"))


def rolling_months(export: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Keep rows exported since the start of the third month before ``as_of``; there is no upper edge."""
    return exported_since(export, window_start(as_of))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """What a DELETE with this condition leaves: rows where it is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
