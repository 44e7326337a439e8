"""Reversible line deduplication: exact reference counts in shards, with a cuckoo filter in front of each.

A ``LineIndex`` keeps, in the shared folder, how many documents hold each line key, and per shard a cuckoo filter of
the keys that have reached the threshold. Documents can be inserted and deleted; a filter changes only where a key
crosses the threshold, so deleting what was inserted restores it. To clean documents, their line keys stream
past the filter of their shard; what the filter lets through is confirmed by the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybook.llm.common import SPACE_BYTES, spread, stored

#: Frequent keys a shard should hold, and the copies of each filter that share the lookups of a shard.
KEYS_EACH = 50_000
SALTS = 16


class CuckooFilter:
    """Set of 64-bit hashes with deletion: four 16-bit tags in each bucket, two buckets for each hash."""

    SLOTS, KICKS = 4, 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, hashes: np.ndarray, load: float = 0.85) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(hashes)) / (cls.SLOTS * load)))))
        while True:
            new = cls(np.zeros((buckets, cls.SLOTS), np.uint16))
            if all(new.insert(int(h)) for h in hashes.view(np.uint64)):
                return new
            buckets *= 2

    def _places(self, h):
        """Tag (never 0) and the two buckets of a hash or of an array of hashes."""
        array = np.atleast_1d(np.asarray(h, np.uint64))
        tag = (array >> np.uint64(48)).astype(np.int64) % 65535 + 1
        one = (array & np.uint64(len(self.table) - 1)).astype(np.int64)
        return tag, one, self._other(one, tag)

    def _other(self, bucket, tag):
        return (bucket ^ (tag * 0x5BD1E995)) & (len(self.table) - 1)

    def insert(self, h: int) -> bool:
        """False, with nothing changed, if no room is found."""
        tag, one, two = (int(x[0]) for x in self._places(h))
        undo: list[tuple[int, int, int]] = []
        at = one
        for step in range(self.KICKS):
            for bucket in (one, two) if not step else (at,):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = tag
                    return True
            slot = step % self.SLOTS
            undo.append((at, slot, int(self.table[at, slot])))
            self.table[at, slot], tag = tag, int(self.table[at, slot])
            at = int(self._other(at, tag))
        for bucket, slot, old in reversed(undo):
            self.table[bucket, slot] = old
        return False

    def delete(self, h: int) -> None:
        """Take out a hash that was inserted."""
        tag, one, two = (int(x[0]) for x in self._places(h))
        for bucket in (one, two):
            held = np.flatnonzero(self.table[bucket] == tag)
            if len(held):
                self.table[bucket, held[0]] = 0
                return
        raise KeyError(h)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        tag, one, two = self._places(hashes)
        tag = tag[:, None]
        return (self.table[one] == tag).any(axis=1) | (self.table[two] == tag).any(axis=1)

    def dumped(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def loaded(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())


def line_keys(text: str | None) -> list[bytes]:
    """The key of every line: white space stripped, A-Z in lower case. No text: one empty line."""
    return [line.strip(SPACE_BYTES).lower() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def pairs(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, key binary, h long) of the lines with a key; rows that share a doc_id are one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = {_digest(key) for key in line_keys(text) if key}
                keys.extend(own)
                rows.extend([row] * len(own))
            h = np.frombuffer(b"".join(keys), "<i8")[::2]
            yield pa.record_batch([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary()), pa.array(h)], ["doc_id", "key", "h"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key binary, h long")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return found if repeated.isEmpty() else found.distinct()


@dataclass(frozen=True)
class LineIndex:
    """counts: (shard, key, h, n); filters: (shard, filter). Each change gives a new index; the old one stays."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    least: int

    @classmethod
    def of(cls, docs: DataFrame, *, least: int = 10, keys_each: int = KEYS_EACH) -> LineIndex:
        return cls.of_pairs(stored(pairs(docs), "line-pairs"), least=least, keys_each=keys_each)

    @classmethod
    def of_pairs(cls, found: DataFrame, *, least: int = 10, keys_each: int = KEYS_EACH) -> LineIndex:
        counts = stored(_counted(found), "line-counts")
        n = counts.where(F.col("n") >= least).count()
        shards = spread(n, keys_each)
        counts = counts.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
        frequent = counts.where(F.col("n") >= least).select("shard", "h")

        def build(key, rows):
            return pd.DataFrame({"shard": [key[0]], "filter": [CuckooFilter.of(np.sort(rows["h"].to_numpy())).dumped()]})

        # a shard holds about ``keys_each`` distinct keys, however many documents share them
        filters = stored(frequent.groupBy("shard").applyInPandas(build, "shard int, filter binary"), "line-filters")
        return cls(counts, filters, shards, least)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Count documents that the index doesn't hold yet."""
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take out documents that were inserted, given with the same texts."""
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        shard = F.pmod("h", F.lit(self.shards)).cast("int").alias("shard")
        change = _counted(pairs(docs)).select(shard, "key", "h", (F.col("n") * sign).alias("change"))
        old = self.counts.select("shard", "key", "h", "n")
        merged = old.join(change, ["shard", "key", "h"], "full").select(
            "shard", "key", "h", F.coalesce("n", F.lit(0)).alias("was"), (F.coalesce("n", F.lit(0)) + F.coalesce("change", F.lit(0))).alias("n")
        )
        merged = stored(merged, "line-counts")
        up = (F.col("n") >= self.least) & (F.col("was") < self.least)
        down = (F.col("n") < self.least) & (F.col("was") >= self.least)
        crossed = merged.where(up | down).select("shard", "h", up.alias("up"))

        def update(key, held, rows):
            now = CuckooFilter.loaded(held["filter"].iloc[0]) if len(held) else CuckooFilter.of(np.zeros(0, np.int64))
            for h in np.sort(rows["h"][~rows["up"]].to_numpy()).view(np.uint64):
                now.delete(int(h))
            fits = all(now.insert(int(h)) for h in np.sort(rows["h"][rows["up"]].to_numpy()).view(np.uint64))
            return pd.DataFrame({"shard": [key[0]], "filter": [now.dumped() if fits else None]})

        filters = self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, "shard int, filter binary")
        filters = stored(filters, "line-filters")
        changed = replace(self, counts=merged.where("n > 0").drop("was"), filters=filters)
        if not filters.where(F.col("filter").isNull()).isEmpty():  # a filter is full: cut the shards anew
            return LineIndex._rebuilt(changed)
        return changed

    def _rebuilt(self) -> LineIndex:
        one = self.counts.select(F.lit(None).cast("long").alias("doc_id"), "key", "h", "n")
        return LineIndex.of_pairs(one, least=self.least)

    def frequent(self, found: DataFrame) -> DataFrame:
        """The pairs of ``found`` whose key has reached the threshold: filtered by shard, confirmed by the counts.

        Filters and pairs are dealt by shard and salt, so a line that a third of all documents hold spreads over
        ``SALTS`` tasks; in a task the filter comes first and the pairs stream past it.
        """
        kind = found.schema["doc_id"].dataType.simpleString()
        shard = F.pmod("h", F.lit(self.shards)).cast("int")
        null = lambda t: F.lit(None).cast(t)
        asked = found.select(shard.alias("shard"), F.pmod(F.hash("doc_id", "key"), F.lit(SALTS)).alias("salt"), "doc_id", "key", "h", null("binary").alias("filter"))
        given = self.filters.select(
            "shard", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"), null(kind).alias("doc_id"), null("binary").alias("key"), null("long").alias("h"), "filter"
        )

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in batches:
                h = batch.column("h").fill_null(0).to_numpy(zero_copy_only=False)
                keep = np.zeros(len(h), bool)
                given = np.flatnonzero(batch.column("filter").is_valid().to_numpy(zero_copy_only=False))
                # rows before the first filter of a batch belong to the filter before; a shard without one holds nothing
                bounds = [*([-1] if not len(given) or given[0] else []), *given.tolist()]
                shards = batch.column("shard").to_numpy()
                for a, b in zip(bounds, [*bounds[1:], len(h)]):
                    if a >= 0:
                        held = shards[a], CuckooFilter.loaded(batch.column("filter")[a].as_py())
                    if held and a + 1 < b:
                        keep[a + 1 : b] = held[1].contains(h[a + 1 : b]) & (shards[a + 1 : b] == held[0])
                yield batch.select(["doc_id", "key", "h"]).filter(pa.array(keep))

        dealt = asked.union(given).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())
        passed = dealt.mapInArrow(look, f"doc_id {kind}, key binary, h long")
        exact = self.counts.where(F.col("n") >= self.least).select("key")
        return passed.join(exact, "key")


def _counted(found: DataFrame) -> DataFrame:
    """Documents for each key. Pairs are distinct unless rows share a doc_id; the counting combines on the map side."""
    if "n" in found.columns:
        return found.groupBy("key", "h").agg(F.sum("n").alias("n"))
    return found.groupBy("key", "h").agg(F.count("*").alias("n"))


def cleaned(docs: DataFrame, *, least: int = 10, counts: str | None = "line_counts") -> DataFrame:
    """All columns of ``docs`` with ``text`` cut, and ``counts`` (struct n_lines, n_dropped) unless that is None.

    If ``docs`` has a column of that name, it stays, and the counts' name gets underscores until it is new.

    Lines whose key at least ``least`` documents hold go, in every document; the others stay as they are, joined by
    line feeds. Lines without a key stay. Null and empty texts are one empty line, and their text becomes empty.
    Rows with the same doc_id are one document, rows with a null doc_id too; each is cleaned. The index is
    built from ``docs`` itself. Texts are read twice and shuffled once.
    """
    found = stored(pairs(docs), "line-pairs")
    index = LineIndex.of_pairs(found, least=least)
    dropped = index.frequent(found).groupBy("doc_id").agg(F.collect_set("key").alias("__dropped_keys"))
    dropped = dropped.withColumnRenamed("doc_id", "__dropped_id")
    joined = docs.join(dropped.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(dropped["__dropped_id"]), "left").drop("__dropped_id")
    names = docs.columns
    schema = StructType([*docs.schema.fields])
    if counts:
        counts += "_" * next(n for n in range(len(names) + 1) if (counts + "_" * n).lower() not in map(str.lower, names))
        schema = schema.add(counts, StructType().add("n_lines", "long").add("n_dropped", "long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("__dropped_keys").to_pylist()):
                lines = (text or "").split("\n")
                kept = lines
                if gone:
                    gone = set(gone)
                    kept = [line for line, key in zip(lines, line_keys(text)) if not key or _digest(key) not in gone]
                texts.append("\n".join(kept))
                numbers.append({"n_lines": len(lines), "n_dropped": len(lines) - len(kept)})
            columns = {name: batch.column(name) for name in names} | {"text": pa.array(texts, pa.string())}
            if counts:
                columns[counts] = pa.array(numbers, pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64())]))
            yield pa.record_batch(list(columns.values()), list(columns))

    return joined.mapInArrow(cut, schema)

