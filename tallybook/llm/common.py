"""Helpers shared by the operators: reading and storing tables, streaming key groups, ranks, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import fresh_folder

#: ASCII white space, as it separates words and ends lines everywhere in this package.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: later steps neither recompute nor lose it."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """A hash of doc_id and text, by which a row is known where doc_ids are missing or repeated."""
    return F.xxhash64("doc_id", "text")


def words_of(text: Column) -> Column:
    """The runs of characters that are not ASCII white space; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def spread(rows: int, each: int) -> int:
    """How many parts of about ``each`` rows ``rows`` make; at least one."""
    return max(1, -(-rows // each))


def whole_groups(batches: Iterable[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Regroup batches sorted by ``key`` so that none ends within a group. Memory: a batch and the longest group."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        ids = batch[key].to_numpy()
        if held and (held[-1][key].to_numpy()[-1] == ids[0]).all():
            pass
        elif held:
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held = []
        same = (ids == ids[-1]).all(axis=1)
        cut = len(batch) - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            held.append(batch.iloc[:cut])
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, root) with the smallest node as root.

    Alternating large and small stars; the edges stay linear in number and the rounds grow with the logarithm of
    the nodes. Every round is written to the shared folder, so a lost executor repeats one round only. Hot nodes
    meet in sort-merge joins that adaptive execution can split.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now.n == 0 or (now.n, now.s) == mark:
            break
        mark = (now.n, now.s)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.union(low).where("a <> b").distinct(), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
