"""Nearest neighbours by a forest of hash prefixes.

The rows are dealt into shards, and each shard is a forest of its own: per tree a sorted array of 64-bit hash strings,
one bit per random hyperplane. A query descends every tree to the longest prefix it shares with any row; from there
all trees ascend together, one bit at a time, until enough rows share the prefix. These candidates are scored exactly.
How many are enough is fitted in each shard on a bounded sample of queries, against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import spread, stored

TREES, BITS = 16, 64
SHARD_ROWS = 8192
#: Each shard fits its number of candidates on at most this many queries, for at least this recall of its own best.
SAMPLE, RECALL = 64, 0.95


class Forest:
    """Trees over the rows of ``vectors`` for the largest inner product.

    Longer vectors win inner products at equal angles, so every row gets a further component that makes all rows
    equally long; queries have 0 there, and angles then order rows as inner products do.
    """

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 11):
        self.vectors = vectors
        square = (vectors**2).sum(axis=1)
        self.planes = np.random.default_rng(seed).normal(size=(trees, vectors.shape[1] + 1, BITS))
        rows = np.c_[vectors, np.sqrt(np.maximum(square.max(initial=0.0) - square, 0))]
        self.hashes = [self._hash(rows, t) for t in range(trees)]
        self.order = [np.argsort(h, kind="stable") for h in self.hashes]
        self.sorted = [h[o] for h, o in zip(self.hashes, self.order)]
        self.enough = 1

    def _hash(self, rows: np.ndarray, tree: int) -> np.ndarray:
        bits = np.packbits(rows @ self.planes[tree] > 0, axis=1)
        return bits.view(">u8").ravel().astype(np.uint64)

    def asked(self, queries: np.ndarray) -> list[np.ndarray]:
        rows = np.c_[queries, np.zeros(len(queries))]
        return [self._hash(rows, t) for t in range(len(self.planes))]

    def bounds(self, hashes: np.ndarray, tree: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The run of the sorted array that shares the first ``level`` bits with each hash."""
        rest = np.uint64((1 << (BITS - level)) - 1)
        low = np.searchsorted(self.sorted[tree], hashes & ~rest, side="left")
        return low, np.searchsorted(self.sorted[tree], hashes | rest, side="right")

    def counts(self, asked: list[np.ndarray]) -> np.ndarray:
        """counts[q, level]: rows over all trees that share at least ``level`` bits with query q; level BITS + 1 has 0."""
        out = np.zeros((len(asked[0]), BITS + 2), np.int64)
        for level in range(BITS + 1):
            for tree, hashes in enumerate(asked):
                low, high = self.bounds(hashes, tree, level)
                out[:, level] += high - low
            if not out[:, level].any():
                break
        return out

    def fit(self, queries: np.ndarray, k: int, recall: float = RECALL) -> None:
        """Set ``enough`` so that the share ``recall`` of the queries' k best rows are among the candidates."""
        asked = self.asked(queries)
        counts = self.counts(asked)
        best = np.argsort(-(queries @ self.vectors.T), axis=1, kind="stable")[:, :k]
        shared = np.zeros(best.shape, np.int64)
        for tree, hashes in enumerate(asked):
            differ = self.hashes[tree][best] ^ hashes[:, None]
            length = np.full(best.shape, BITS)
            for bit in range(BITS - 1, -1, -1):  # the first differing bit counts last
                length[(differ >> np.uint64(BITS - 1 - bit)) & np.uint64(1) != 0] = bit
            shared = np.maximum(shared, length)
        needed = np.take_along_axis(counts, shared + 1, axis=1) + 1  # the ascent must not stop before this level
        self.enough = int(np.sort(needed.ravel())[int(np.ceil(recall * needed.size)) - 1]) if needed.size else 1

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows found and their inner products: the k best candidates, and any that tie with them."""
        asked = self.asked(queries)
        counts = self.counts(asked)
        level = np.maximum((counts >= min(self.enough, len(self.planes) * len(self.vectors))).sum(axis=1) - 1, 0)
        runs = np.zeros((len(self.planes), 2, len(queries)), np.int64)
        for tree, hashes in enumerate(asked):
            for one in np.unique(level):
                own = level == one
                runs[tree, 0, own], runs[tree, 1, own] = self.bounds(hashes[own], tree, int(one))
        for q, query in enumerate(queries):
            mask = np.zeros(len(self.vectors), bool)
            for tree, order in enumerate(self.order):
                mask[order[runs[tree, 0, q] : runs[tree, 1, q]]] = True
            rows = np.flatnonzero(mask)
            scores = self.vectors[rows] @ query
            if len(rows) > k:
                edge = np.partition(scores, -k)[-k]
                rows = rows[scores >= edge - 1e-9 * max(1.0, abs(edge))]
            yield rows, (self.vectors[rows] * query).sum(axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array of double) of the rows that take part: no null, zero or non-finite vectors, and of
    the most frequent length (the larger of equally frequent ones)."""
    part = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    sizes = part.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("rows"))
    size = sizes.orderBy(F.desc("rows"), F.desc("n")).limit(1).collect()
    return part.where(F.size("embedding") == (size[0].n if size else 0))


def nearest(vectors: DataFrame, is_query, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with ``is_query`` (a condition on vec_id) its k nearest found.

    Equal vectors are one class: indexed once, asked once, and known by their k + 1 smallest vec_ids, which is all
    that any k nearest can show of them. Rows that repeat a vec_id and vector are one row; every row that shares the
    query's vec_id is its own and no candidate. Null vec_ids take no part. Columns other than vec_id and embedding
    are ignored.
    """
    part = usable(vectors).distinct()
    numbered = part.withColumn("n", F.row_number().over(W.partitionBy("embedding").orderBy("vec_id")))
    members = stored(numbered.where(F.col("n") <= k + 1), "forest-members")
    queries = stored(part.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding"), "forest-queries")
    classes = members.where("n = 1").select(F.col("vec_id").alias("class_id"), "embedding")
    shards = spread(classes.count(), shard_rows)
    # a query's vector is asked under the id of its class
    asking = classes.join(queries.select("embedding").distinct(), "embedding", "left_semi")
    rows = classes.select(F.pmod(F.xxhash64("class_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), "class_id", "embedding")
    asks = asking.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"), "class_id", "embedding")
    dealt = rows.union(asks).repartition("shard").sortWithinPartitions("shard", "kind", F.xxhash64("class_id"), "class_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, held, forest = None, [], [], None
        waiting: list[tuple] = []  # queries, until there are enough to fit the forest or the shard ends

        def answered() -> Iterator[pa.RecordBatch]:
            nonlocal forest, waiting
            some, waiting = waiting, []
            if not some or not ids:  # a shard without rows
                return
            own, data = (np.concatenate(x) for x in zip(*some))
            if forest is None:
                forest = Forest(np.concatenate(held))
                forest.fit(data[:SAMPLE], min(k + 1, len(forest.vectors)))
            names = np.concatenate(ids)
            for i in range(0, len(own), 512):
                asked, found, scores = [], [], []
                for q, (hits, products) in zip(own[i : i + 512], forest.search(data[i : i + 512], k + 1)):
                    asked.append(np.full(len(hits), q))
                    found.append(names[hits])
                    scores.append(products)
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (asked, found, scores)], ["asked", "class_id", "score"])

        for batch in batches:
            shard, kind, own = (batch.column(n).to_numpy() for n in ("shard", "kind", "class_id"))
            width = len(batch.column("embedding").flatten()) // max(1, len(own))
            data = batch.column("embedding").flatten().to_numpy().reshape(-1, width) if len(own) else np.zeros((0, 1))
            edges = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])]) if len(own) else []
            for a, b in zip(edges, [*edges[1:], len(own)]):
                if shard[a] != at:
                    yield from answered()
                    at, ids, held, forest = shard[a], [], [], None
                if not kind[a]:
                    ids.append(own[a:b])
                    held.append(data[a:b])
                    continue
                waiting.append((own[a:b], data[a:b]))
                if forest is not None or sum(len(w[0]) for w in waiting) >= SAMPLE:
                    yield from answered()
        yield from answered()

    hits = dealt.mapInArrow(run, "asked long, class_id long, score double")
    by_score = W.partitionBy("asked").orderBy(F.desc("score"), "class_id")
    best = hits.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1).drop("n")
    return _expanded(best, members, queries, k)


def _expanded(best: DataFrame, members: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """From the best classes of a class to the nearest rows of each query in it."""
    first = members.where("n = 1").select("embedding", F.col("vec_id").alias("class_id"))
    grouped = members.join(first, "embedding").select("class_id", "vec_id")
    to_class = queries.join(first.withColumnRenamed("class_id", "asked"), "embedding").select("query_id", "asked")
    # k + 1 rows answer for the whole class; each query then leaves itself out
    rows = best.join(grouped, "class_id")
    by_score = W.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1).drop("n")
    pairs = to_class.join(rows, "asked").where("query_id <> vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
