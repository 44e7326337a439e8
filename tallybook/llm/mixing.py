"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

The slots of the mix are points of the golden-ratio sequence. Each point falls into the share of one source, the
slots of a source are ranked, and the slot of rank r takes block r (around again after the last) of the source's
documents, which were shuffled and cut into blocks of equally many words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import SPACE, row_key, stored

GOLDEN = 0.6180339887498949
#: Slots a source has at least, if it has words enough: the schedule is off by a few slots a source.
LEAST_SLOTS = 256
MOST_BLOCK = 4096
#: Slots and documents are ranked in chunks: so many slots, and so many leading digits of the shuffling hash.
SLOT_CHUNK = 65536
HASH_DIGITS = 3


@dataclass
class Mix:
    """sources: one row each; documents: one row per input row; schedule: one row per slot."""

    sources: DataFrame
    documents: DataFrame
    schedule: DataFrame


def size_of(text: Column) -> Column:
    """Words of a text; 0 for null."""
    text = F.coalesce(text, F.lit(""))
    return F.size(F.array_remove(F.split(text, f"{SPACE}+"), "")).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: int = 150, limit: int = 2) -> DataFrame:
    """Per source: source_size, weight, target and its place in order of code points, null last.

    All sources together get ``share`` per cent of all words, by weight; a target stops at ``limit`` times its
    source's size and the excess goes to the others. That fills all sources to one level per weight, so the sources
    are ordered by the level at which they stop and the level follows from running sums. The table has one row per
    source, which is what the unpartitioned windows here see.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("place", F.row_number().over(order) - 1)
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * limit
    by_level = W.orderBy(cap / F.col("weight"), "place")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    level = (F.col("whole") - F.col("stopped")) / F.col("weights_left")
    return (
        named.withColumn("weight", pick.cast("long"))
        .withColumn("whole", F.sum("source_size").over(W.partitionBy(F.lit(0))) * share / 100.0)
        .withColumn("stopped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(W.partitionBy(F.lit(0))) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", level)
        # the first source in this order that its level doesn't stop sets the level of all that follow
        .withColumn("n", F.row_number().over(by_level))
        .withColumn("common", F.min(F.when(level * F.col("weight") <= cap, F.struct("n", "level"))).over(W.partitionBy(F.lit(0)))["level"])
        .withColumn("target", F.least(cap.cast("double"), F.coalesce(F.col("common") * F.col("weight"), cap.cast("double"))))
        .select("source", "place", "source_size", "weight", "target")
    )


def slots(sources: DataFrame) -> DataFrame:
    """The schedule: slot, place (of its source) and rank among the slots of that source, from ``sources`` with n_slots.

    A slot's point is mapped to a source by a join of counted intervals, chunk by chunk, and ranked within its
    chunk; counts of earlier chunks are added. A source that holds most slots is spread over the chunks.
    """
    spark = sources.sparkSession
    shares = sources.withColumn("upto", F.sum("n_slots").over(W.orderBy("place"))).where("n_slots > 0")
    total = shares.agg(F.max("upto")).first()[0] or 0
    point = F.col("slot") * F.lit(GOLDEN)
    cell = F.floor((point - F.floor(point)) * total)
    ends = [r.upto for r in shares.orderBy("upto").select("upto").collect()]
    places = [r.place for r in shares.orderBy("upto").select("place").collect()]
    # one entry per source: the number of interval ends at or below the cell is the index of its source
    index = F.size(F.filter(F.array(*map(F.lit, ends)) if ends else F.array().cast("array<bigint>"), lambda e: e <= cell))
    drawn = (
        spark.range(total).withColumnRenamed("id", "slot")
        .withColumn("chunk", F.floor(F.col("slot") / SLOT_CHUNK))
        .withColumn("place", F.get(F.array(*map(F.lit, places)) if places else F.array().cast("array<int>"), index))
    )
    counted = drawn.groupBy("place", "chunk").agg(F.count("*").alias("n"))
    before = W.partitionBy("place").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.select("place", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(W.partitionBy("place", "chunk").orderBy("slot")) - 1
    return drawn.withColumn("inside", inside).join(counted, ["place", "chunk"]).select("slot", "place", (F.col("earlier") + F.col("inside")).alias("rank"))


def mixed(docs: DataFrame, **options) -> Mix:
    """Mix all rows of ``docs`` (doc_id, text, source).

    documents: doc_id, row_key, source, size, source_size, target, taken (words of the row the mix takes, repeats counted) and
    copies (0 to ``limit``: how often the block with the row's first word is taken, for mixes of whole documents).
    Null texts have size 0 and take nothing, null sources come last, a null doc_id is shuffled like any other value;
    repeated rows are separate documents. Rows that share an id follow each other by a hash of their text, so the order
    of the input changes nothing. An empty table gives no documents. Texts are read once, for their sizes, however long.
    """
    limit = options.get("limit", 2)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    sizes = stored(docs.select("doc_id", F.col("source"), row_key().alias("row_key"), size_of(F.col("text")).alias("size"), key.alias("key")), "mixing-sizes")
    block = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(1), F.floor(F.col("target") / LEAST_SLOTS)))
    sources = (
        targets(sizes, **options).withColumn("block", block.cast("long"))
        .withColumn("n_slots", F.least(F.floor(F.col("target") / F.col("block") + 0.5), F.floor(limit * F.col("source_size") / F.col("block"))).cast("long"))
        .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    )
    sources = stored(sources, "mixing-sources")

    # the words of a source before a document in shuffled order: sums of earlier chunks of the hash, then within it
    placed = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(sizes["*"], *[c for c in sources.columns if c != "source"])
    placed = placed.withColumn("chunk", F.substring("key", 1, HASH_DIGITS))
    sums = placed.groupBy("place", "chunk").agg(F.sum("size").alias("n"))
    before = W.partitionBy("place").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("place", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    order = W.partitionBy("place", "chunk").orderBy("key", "doc_id", "size", "row_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = placed.withColumn("upto", F.sum("size").over(order)).join(sums, ["place", "chunk"])
    placed = placed.withColumn("start", F.col("earlier") + F.col("upto") - F.col("size"))

    # the points may give a source a few slots more than its share: none goes around more than ``limit`` times
    schedule = slots(sources).join(sources.select("place", "source", "n_blocks"), "place").where(F.col("rank") < limit * F.col("n_blocks"))
    schedule = schedule.select("slot", "source", "place", "rank", (F.col("rank") % F.col("n_blocks")).alias("number"))
    uses = stored(schedule.groupBy("place", "number").agg(F.count("*").alias("uses")), "mixing-uses")

    first, last = F.floor(F.col("start") / F.col("block")), F.floor((F.col("start") + F.col("size") - 1) / F.col("block"))
    parts = placed.where("size > 0").withColumn("number", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    words = F.least(F.col("start") + F.col("size"), (F.col("number") + 1) * F.col("block")) - F.greatest("start", F.col("number") * F.col("block"))
    parts = parts.join(uses, ["place", "number"], "left").withColumn("uses", F.coalesce(F.col("uses"), F.lit(0)))
    taken = parts.groupBy("place", "start").agg(
        F.sum(words * F.col("uses")).alias("taken"),
        F.min(F.struct("number", "uses"))["uses"].alias("copies"),
    )
    # a document of no words shares its start with the next one, which alone has parts
    documents = placed.withColumn("at", F.when(F.col("size") > 0, F.col("start"))).join(
        taken.withColumnRenamed("start", "at"), ["place", "at"], "left"
    )
    zero = F.lit(0).cast("long")
    documents = documents.select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", zero).alias("taken"), F.coalesce("copies", zero).cast("int").alias("copies"), "row_key",
    )
    return Mix(sources, documents, schedule)
