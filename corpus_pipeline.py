"""The corpus pipeline: five operators in a row, from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's documents. All but the last keep the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm import line_dedup, mixing, packing, quality_rules, simhash
from tallybook.llm.common import row_key, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or the learned rules reject."""
    verdicts = quality_rules.judged(docs, table(spark, sf_dir, "labels"))
    rejected = verdicts.where(~F.col("kept")).select(F.col("row_key").alias("__key")).distinct()
    return docs.withColumn("__key", row_key()).join(rejected, "__key", "left_anti").drop("__key")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the lines that ten documents or more share. All columns are kept; null texts become empty. An empty table
    stays empty."""
    return _counted(line_dedup.cleaned(docs, counts=None), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of texts whose fingerprints of three-word shingles differ from another's in two
    bits at most: the one with the smallest doc_id, and of rows that share it, or of a group without ids, the one with
    the smallest hash. Null and empty texts are one group. An empty table stays empty; all columns are kept."""
    group = W.partitionBy("component_id", F.when(F.col("component_id").isNull(), F.col("root"))).orderBy("row_key")
    found = simhash.groups(docs, shingle=3, radius=2).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = found.withColumn("n", F.row_number().over(group)).where("n = 1").select(F.col("row_key").alias("__key"))
    # the rows of one key lie together after the join, so dropping repeated ones needs no second shuffle
    keyed = docs.withColumn("__key", row_key())
    return keyed.join(chosen, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    taken = mixing.mixed(docs).documents.where("copies > 0").groupBy(F.col("row_key").alias("__key"))
    taken = taken.agg(F.sum("copies").cast("int").alias("__copies"))
    # repeated rows share a key: one of them stands for all, as often as all are taken
    joined = docs.withColumn("__key", row_key()).join(taken, "__key").dropDuplicates(["__key"])
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).drop("__key", "__copies", "__copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: one row per piece of a document."""
    return packing.packed(docs)


def _counted(new: DataFrame, old: DataFrame) -> DataFrame:
    if "n_chars" in old.columns:
        new = new.withColumn("n_chars", F.length("text").cast(old.schema["n_chars"].dataType))
    return new.select(*old.columns)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]
#: Learned rules, fingerprints and the tokenizer have no SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
