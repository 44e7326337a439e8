"""Session settings the plans rely on, and the shared folder for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Java does not compile methods above 8000 bytes; wide rows run faster in several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the required settings: UTC dates, ANSI arithmetic, run-time re-planning with skew splits."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return _LOCAL[0]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}/{uuid.uuid4().hex}"
