"""Spelling variants: words one edit apart, and the frequent form that a rare one leads to.

Each word is a point: how often it has each letter. One edit changes at most two of these counts by one each, so near
words of the same length lie at an L1 distance of at most two, and words a letter longer at a distance of one. A k-d
tree for each length is searched by box: its upper levels cut the words into cells that are dealt over the cluster, the
lower ones are built where a cell lies. What a box can't rule out is compared letter by letter.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import stored

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Dimensions of a point: a to z, and six for all other letters.
SIDES = 32
#: A cell has about this many words, a cell of more than twice as many is dealt out in parts, and a leaf has at most LEAF.
CELL, LEAF = 16_000, 24
#: Pairs of a word and a leaf that are compared at once.
BLOCK = 20_000


def runs(docs: DataFrame, least: int, drop: int | None) -> DataFrame:
    """``word``: every maximal run of letters in the texts, lower-cased by A to Z, of at least ``least`` code points.

    With ``drop``, a run whose checksum with its doc_id divides by it loses one letter, as a slip of the pen would. A
    null doc_id counts as an empty one.
    """
    found = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{LETTERS}{{{least},}}+"), 0))
    own = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), found.alias("run"))
    own = own.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    if drop is None:
        return own.select(F.col("run").alias("word"))
    own = own.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return own.select(F.when(F.col("h") % drop == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(docs: DataFrame, *, least: int = 7, times: int = 2, drop: int | None = 31) -> DataFrame:
    """word, n: the distinct words of all whole texts with at least ``least`` letters and ``times`` occurrences.

    Null and empty texts have none. Words are counted in each task first, so a very frequent one is one row from each.
    """
    counted = runs(docs, least, drop).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= times)


def letters_of(words: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and where each word ends."""
    text = "".join(words.to_pylist())
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points, np.cumsum(np.fromiter(map(len, words.to_pylist()), np.int64, len(words)))


def counts_of(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The points in letter space: a row of SIDES counts for each word."""
    side = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % 6).astype(np.int64)
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    counts = np.bincount(row * SIDES + side, minlength=len(ends) * SIDES).reshape(-1, SIDES)
    return counts.astype(np.int8 if counts.max(initial=0) < 64 else np.int32)


def upper_levels(words: DataFrame, cell: int = CELL) -> dict[int, list[tuple[int, int]]]:
    """The cuts (side, most) of the tree of each length: a word goes up where its count of that side is over ``most``.

    One histogram over all words gives the cuts that halve a length best. Only lengths of over ``cell`` words have
    any, so the driver gets at most SIDES rows for each and count that occurs there.
    """

    def run(batches):
        for batch in batches:
            points, ends = letters_of(batch.column("word"))
            length, counts = np.diff(ends, prepend=0), counts_of(points, ends)
            key = np.stack([np.repeat(length, SIDES), np.tile(np.arange(SIDES), len(length)), counts.ravel()], axis=1)
            key, n = np.unique(key, axis=0, return_counts=True) if len(key) else (key, key[:, 0])
            yield pa.record_batch([*(pa.array(key[:, i].astype(np.int64)) for i in range(3)), pa.array(n.astype(np.int64))], names)

    names = ["length", "side", "most", "n"]
    large = words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("all")).where(F.col("all") > cell)
    found = words.join(large, F.length("word") == F.col("size"), "left_semi").select("word")
    found = found.mapInArrow(run, "length long, side long, most long, n long").groupBy("length", "side", "most").agg(F.sum("n").alias("n"))
    by_length: dict[int, dict[int, dict[int, int]]] = {}
    for row in found.collect():
        by_length.setdefault(row.length, {}).setdefault(row.side, {})[row.most] = row.n
    cuts = {}
    for length, sides in by_length.items():
        total = sum(sides[0].values())
        ranked = []
        for side, held in sides.items():
            below = 0
            for most in sorted(held)[:-1]:
                below += held[most]
                ranked.append((abs(2 * below - total), side, most))
        one_each, used = [], set()
        for _, side, most in sorted(ranked):
            if side not in used:
                used.add(side)
                one_each.append((side, most))
        cuts[length] = one_each[: max(0, math.ceil(math.log2(total / cell)))]
    return cuts


def cells(counts: np.ndarray, cuts: list[tuple[int, int]], change: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells (rows of ``counts``, cell numbers) in which a word may have near ones, of its length (``change`` 2) or
    a letter longer (``change`` 1); with ``change`` 0 just its own."""
    rows = np.arange(len(counts))
    own = np.zeros(len(counts), np.int64)
    up, down = [], []
    for bit, (side, most) in enumerate(cuts):
        own |= (counts[:, side] > most).astype(np.int64) << bit
        up.append(np.where(counts[:, side] == most, 1 << bit, 0))
        down.append(np.where(counts[:, side] == most + 1, 1 << bit, 0))
    found = [(rows, own)]
    if change:
        for i, one in enumerate(up):
            a = np.flatnonzero(one)
            found.append((a, own[a] ^ one[a]))
            for j, other in enumerate(down if change == 2 else []):
                both = np.flatnonzero((one > 0) & (other > 0)) if i != j else a[:0]
                found.append((both, own[both] ^ one[both] ^ other[both]))
        for one in down if change == 2 else []:
            a = np.flatnonzero(one)
            found.append((a, own[a] ^ one[a]))
    return np.concatenate([r for r, _ in found]), np.concatenate([c for _, c in found])


class Packed:
    """Words of a group as lanes of 64-bit numbers, letters numbered in code-point order from 1, as many as fit."""

    def __init__(self, points: np.ndarray, ends: np.ndarray):
        letters = np.unique(points)
        self.width = 8 if len(letters) < 255 else 32
        kind, each = (np.uint8, 8) if self.width == 8 else (np.uint32, 2)
        numbers = (np.searchsorted(letters, points) + 1).astype(kind)
        length = np.diff(ends, prepend=0)
        self.length = length
        lanes = max(1, -(-int(length.max(initial=1)) // each))
        row, begin = np.repeat(np.arange(len(ends)), length), np.repeat(ends - length, length)
        place = np.arange(len(points)) - begin
        forward, backward = (np.zeros((len(ends), lanes * each), kind) for _ in range(2))
        forward[row, place] = numbers
        backward[row, np.repeat(length, length) - 1 - place] = numbers
        self.forward, self.backward = forward.view("<u8"), backward.view("<u8")
        high = sum(1 << (self.width * (i + 1) - 1) for i in range(each))
        self.high, self.rest = np.uint64(high), np.uint64((1 << 64) - 1 - high)
        self.order = np.lexsort(forward.T[::-1]) if len(ends) else np.zeros(0, np.int64)

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many places words of one length differ."""
        total = np.zeros(len(a), np.int64)
        for lane in range(self.forward.shape[1]):
            x = self.forward[a, lane] ^ self.forward[b, lane]
            total += np.bitwise_count((((x & self.rest) + self.rest) | x) & self.high)
        return total

    def shared(self, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters are the same from the start on."""
        same, open_ = np.zeros(len(a), np.int64), np.ones(len(a), bool)
        for lane in range(words.shape[1]):
            x = words[a, lane] ^ words[b, lane]
            lowest = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // self.width
            same += np.where(open_, np.where(x == 0, 64 // self.width, lowest), 0)
            open_ &= x == 0
        return same

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``b``, as long as ``a`` or a letter longer, is one edit away."""
        longer = self.length[b] != self.length[a]
        found = np.zeros(len(a), bool)
        k = np.flatnonzero(~longer)
        found[k] = self.differing(a[k], b[k]) == 1
        k = np.flatnonzero(longer)
        found[k] = self.shared(self.forward, a[k], b[k]) + self.shared(self.backward, a[k], b[k]) >= self.length[a[k]]
        return found


class Tree:
    """A k-d tree over letter counts, cut at the median of the side that spreads most; leaves hold ranges of ``order``."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.order = np.arange(len(counts))
        self.low, self.high, self.left, self.right, self.range = [], [], [], [], []
        self._node(counts, 0, len(counts), leaf)
        self.low, self.high = np.array(self.low, counts.dtype), np.array(self.high, counts.dtype)
        self.left, self.right, self.range = np.array(self.left), np.array(self.right), np.array(self.range)

    def _node(self, counts: np.ndarray, begin: int, end: int, leaf: int) -> int:
        own = counts[self.order[begin:end]]
        number = len(self.low)
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.left.append(-1)
        self.right.append(-1)
        self.range.append((begin, end))
        side = int(np.argmax(own.var(axis=0)))
        if end - begin > leaf and self.low[-1][side] < self.high[-1][side]:
            most = np.median(own[:, side])
            above = own[:, side] > most if most < self.high[-1][side] else own[:, side] >= most
            self.order[begin:end] = self.order[begin:end][np.argsort(above, kind="stable")]
            middle = end - int(above.sum())
            self.left[number] = self._node(counts, begin, middle, leaf)
            self.right[number] = self._node(counts, middle, end, leaf)
        return number

    def leaves(self, asks: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (row of ``asks``, leaf) whose box reaches within the row's radius."""
        found = []
        row, node = np.arange(len(asks)), np.zeros(len(asks), np.int64)
        while len(row):
            own = asks[row]
            gap = np.maximum(self.low[node] - own, own - self.high[node])
            # counts of gaps, each cut to 0 to 3, as bytes: 32 of them fit a byte when added up
            gap = np.minimum(np.maximum(gap, 0, out=gap), 3, out=gap).astype(np.int8, copy=False).view(np.uint64)
            total = (gap[:, 0] + gap[:, 1] + gap[:, 2] + gap[:, 3]) * np.uint64(0x0101010101010101) >> np.uint64(56)
            within = total <= radius[row]
            row, node = row[within], node[within]
            last = self.left[node] < 0
            found.append((row[last], node[last]))
            row, node = row[~last], node[~last]
            row, node = np.r_[row, row], np.r_[self.left[node], self.right[node]]
        return np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])


def near_in(words: Packed, counts: np.ndarray, points: np.ndarray, asks: np.ndarray):
    """Yield the near pairs (ask, point) of a cell, as rows of ``words``."""
    tree = Tree(counts[points], LEAF)
    length = words.length[points[0]]
    for begin in range(0, len(asks), BLOCK // 4):
        own = asks[begin : begin + BLOCK // 4]
        row, leaf = tree.leaves(counts[own], np.where(words.length[own] == length, 2, 1).astype(np.uint64))
        for at in range(0, len(row), BLOCK):
            first, last = tree.range[leaf[at : at + BLOCK]].T
            size = last - first
            # a leaf of many equal points is taken a slice at a time
            done = 0
            while (left := np.minimum(size - done, 4 * LEAF)).max(initial=0) > 0:
                left = np.maximum(left, 0)
                inside = np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left) + np.repeat(first + done, left)
                a, b = np.repeat(own[row[at : at + BLOCK]], left), points[tree.order[inside]]
                kept = words.near(a, b)
                yield a[kept], b[kept]
                done += 4 * LEAF


def near_words(words: DataFrame, *, cell: int = CELL) -> DataFrame:
    """word, n_near, form (the near word of largest n, of these the smallest), form_n: a row for each word with near ones.

    ``words`` has distinct words (column ``word``) of any letters with their numbers ``n``. A word goes as a point to
    its own cell and asks in each cell that an edit could lead to: its own and those across cuts where its count lies
    at the cut, so with d cuts at most about d * d / 4 cells. Ties within a cell's counts (words of the same letters)
    are compared with each other.
    """
    cuts = upper_levels(words, cell)

    def deal(batches):
        for batch in batches:
            points, ends = letters_of(batch.column("word"))
            counts, length = counts_of(points, ends), np.diff(ends, prepend=0)
            out = []
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                for longer, change in ((0, 0), (0, 2), (1, 1)):
                    row, number = cells(counts[rows], cuts.get(int(size + longer), []), change)
                    out.append((rows[row], np.full(len(row), size + longer), number, np.full(len(row), change > 0)))
            row, size, number, ask = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
            own = batch.take(pa.array(row))
            yield pa.record_batch([own.column("word"), own.column("n"), pa.array(size.astype(np.int64)), pa.array(number), pa.array(ask.astype(bool))], names)

    names = ["word", "n", "size", "cell", "ask"]
    dealt = words.select("word", "n").mapInArrow(deal, "word string, n long, size long, cell long, ask boolean")
    parts = dealt.where("not ask").groupBy("size", "cell").agg(F.ceil(F.count("*") / (2 * cell)).cast("int").alias("parts"))
    # a cell without points has no row here, so nothing is asked in it
    dealt = dealt.join(parts, ["size", "cell"])
    part: Column = F.when(F.col("ask"), F.sequence(F.lit(0), F.col("parts") - 1))
    part = part.otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    dealt = dealt.withColumn("part", F.explode(part)).select("word", "n", "size", "cell", "part", "ask")

    def search(group: pa.Table) -> pa.Table:
        asks = group.column("ask").to_numpy()
        letters, ends = letters_of(group.column("word"))
        packed, counts, n = Packed(letters, ends), counts_of(letters, ends), group.column("n").to_numpy()
        size = group.column("size")[0].as_py()
        found = []
        if not asks.all() and asks.any():
            for a, b in near_in(packed, counts, np.flatnonzero(~asks), np.flatnonzero(asks)):
                longer = packed.length[a] != size
                found += [(a, b), (b[longer], a[longer])]
        one = np.concatenate([a for a, _ in found]) if found else np.zeros(0, np.int64)
        other = np.concatenate([b for _, b in found]) if found else one
        place = np.empty(len(n), np.int64)
        place[packed.order] = np.arange(len(n))
        order = np.lexsort((place[other], -n[other], one))
        one, other = one[order], other[order]
        first = np.flatnonzero(np.r_[True, one[1:] != one[:-1]]) if len(one) else one
        names = group.column("word")
        return pa.table({
            "word": names.take(pa.array(one[first])), "n_near": np.diff(np.r_[first, len(one)]).astype(np.int64),
            "form": names.take(pa.array(other[first])), "form_n": n[other[first]],
        })

    found = dealt.groupBy("size", "cell", "part").applyInArrow(search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", "best.form", (-F.col("best.m")).alias("form_n"))


def variants(words: DataFrame, *, ratio: int = 10, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near, form_n: every distinct word with the form it is a variant of.

    The form is the near word of largest ``n`` (ties: the smallest in code-point order) if that is at least ``ratio``
    (2 or more) times the word's own, else null; the root is where following the forms ends. ``words`` has distinct, not null
    words in ``word`` and their numbers in ``n``; other columns are ignored. An empty table gives no rows. Words of any
    length are compared, those of a length together; the n of forms grows by ``ratio`` with each step, which bounds the
    steps.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = stored(near_words(words, cell=cell), "near-words")
    all_ = words.join(near, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))
    leads = F.col("form_n") >= ratio * F.col("n")
    all_ = all_.withColumns({"form": F.when(leads, F.col("form")), "form_n": F.when(leads, F.col("form_n"))})
    all_ = stored(all_, "forms")
    steps = all_.agg(F.max("n"), F.min("n")).first()
    longest = math.log(steps[0] / max(1, steps[1]), ratio) if steps[0] else 0
    root = all_.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < longest:  # each round doubles how far a word has followed its forms
        then = root.select(F.col("word").alias("root"), F.col("root").alias("then"))
        root = stored(root.join(then, "root", "left").select("word", F.coalesce("then", "root").alias("root")), "roots")
        reach *= 2
    out = all_.join(root, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
