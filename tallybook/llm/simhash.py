"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are compared only within buckets that share two quarters of their bits. In a bucket the bits are stored
vertically: plane b holds bit b of every fingerprint, packed into one long integer. Shifting a plane by d lanes and
combining it with itself compares every fingerprint with its d-th neighbour at once; carry-save counters, vertical as
well, add up the distances plane by plane, and the comparison is abandoned once every lane exceeds the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import components, row_key, stored, whole_groups

BITS = 64
#: Buckets with more fingerprints are cut once more, by two quarters of their remaining 32 bits; then 16 bits are
#: free, so no bucket holds more than 65,536 fingerprints.
LARGE = 8192
PARTS = list(combinations(range(4), 2))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the XXH64 hashes (seed 42) of the shingles, repeats included; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = [0, *(ends[:-1] + 1).tolist()][: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, row_key long, print long) of every whole text; row_key is a hash of doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            columns = [batch.column("doc_id"), batch.column("row_key"), pa.array(prints.view(np.int64))]
            yield pa.record_batch(columns, ["doc_id", "row_key", "print"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", row_key().alias("row_key")).mapInArrow(run, f"doc_id {kind}, row_key long, print long")


def links(prints: np.ndarray, buckets: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``radius`` bits and the same bucket; ``buckets`` is sorted."""
    n = len(prints)
    unsigned = prints.view(np.uint64)
    pack = lambda bits: int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    planes = [pack((unsigned >> np.uint64(b)) & np.uint64(1) != 0) for b in range(BITS)]
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    width = radius.bit_length() + 1  # counters are this many bits; a further carry means far too distant
    for d in range(1, n):
        together = buckets[d:] == buckets[:-d]
        if not together.any():
            break
        alive = pack(together)
        counters = [0] * width
        for plane in planes:
            carry = (plane ^ (plane >> d)) & alive
            for i in range(width):
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
                if not carry:
                    break
            alive &= ~carry
            alive &= ~_over(counters, radius)
            if not alive:
                break
        if alive:
            bits = np.frombuffer(alive.to_bytes((n + 7) // 8, "little"), np.uint8)
            at = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
            left.append(at)
            right.append(at + d)
    return np.concatenate(left), np.concatenate(right)


def _over(counters: list[int], radius: int) -> int:
    """The lanes whose count, written vertically, is more than ``radius``."""
    over, equal = 0, -1
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            over |= equal & counters[i]
            equal &= ~counters[i]
    return over


def _stars(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Every linked fingerprint with the smallest one it reaches within its bucket."""
    for group in whole_groups(batches, ["part", "key"]):
        part, key, prints = (group[c].to_numpy() for c in ("part", "key", "print"))
        number = np.cumsum(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
        size = np.bincount(number)[number]
        number, prints = number[size > 1], prints[size > 1]
        a, b = links(prints, number, radius)
        if not len(a):
            continue
        root = np.arange(len(prints))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield pd.DataFrame({"a": prints[moved], "b": prints[root[moved]]})


def near_prints(distinct: DataFrame, radius: int = 2, large: int = LARGE) -> DataFrame:
    """Linked fingerprints (a, b): together they span the groups of all pairs within ``radius`` bits.

    ``distinct``: column print, no value twice. With at most ``radius`` (2 at most) bits different, two of four
    quarters are equal; the six choices of two quarters are the keys. Buckets over ``large`` are cut again the same
    way over their other half, so no pair is lost and no bucket is unbounded. Equal prints are no links here.
    """
    if not 0 <= radius <= 2:
        raise ValueError("two equal quarters are certain up to radius 2 only")
    quarter = lambda i, shift=16: F.shiftright("print", shift * i).bitwiseAND(F.lit((1 << shift) - 1))
    keys = F.array(*[
        F.struct(F.lit(n).alias("part"), (quarter(i) * 65536 + quarter(j)).alias("key")) for n, (i, j) in enumerate(PARTS)
    ])
    keyed = distinct.select("print", F.inline(keys))
    counted = keyed.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(keyed.join(counted, ["part", "key"]), "simhash-buckets")
    finer = []
    for n, (i, j) in enumerate(PARTS):
        rest = [quarter(2 * q + h, 8) for q in range(4) if q not in (i, j) for h in (0, 1)]
        finer += [
            F.when(F.col("part") == n, F.struct(F.lit(n * 6 + m + 6).alias("part"), ((F.col("key") * 256 + rest[x]) * 256 + rest[y]).alias("key")))
            for m, (x, y) in enumerate(PARTS)
        ]
    again = F.filter(F.array(*finer), lambda k: k.isNotNull())
    cut = shared.where(F.col("n") > large).select("print", F.inline(again))
    todo = shared.where(F.col("n") <= large).select("print", "part", "key").union(cut)
    # the pair of columns spreads the buckets; sorting them groups each in one run of rows
    todo = todo.repartition("part", "key").sortWithinPartitions("part", "key", "print")
    return todo.mapInPandas(lambda batches: _stars(batches, radius), "a long, b long")


def groups(docs: DataFrame, *, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, row_key, print (long), component_id, root (a print that names the group) of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id in the row's group, null doc_ids aside (null if it has no other). Null and
    empty texts share fingerprint 0. Copies and repeated rows share a fingerprint and are compared once. Columns
    other than doc_id and text are ignored. An empty table gives no rows; texts of any length are hashed whole.
    """
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    classes = stored(classes, "simhash-classes")
    found = components(near_prints(classes.select("print"), radius))
    rooted = classes.join(found, classes["print"] == found["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(smallest, "root").select("print", "component_id", "root")
    return prints.join(known, "print").select("doc_id", "row_key", "print", "component_id", "root")
