"""Removal of repeated passages with suffix arrays built by induced sorting.

Every string of ``length`` bytes belongs to the smallest hash of its 32-byte pieces, its anchor; equal strings have
equal anchors, so a string can only repeat among the strings of its anchor. The strings of one anchor that follow one
another in a text form a region. Equal regions are counted before anything else; only anchors with several
different regions need suffix arrays. Regions are dealt into shards by anchor; a shard's suffix array is induced
from its sorted leftmost-smaller substrings, and permuted common prefixes of at least ``length`` bytes show the repeats.

Whether a text shares a run of ``words`` words with another one, however few bytes that has, is told from regions of
words, found in the same way. Where an anchor's regions differ, their runs are counted by their hashes in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import SPACE_BYTES, stored

LENGTH = 400
#: Bytes of a piece, less for short strings. Ordinary wording repeats pieces of 16, and each such anchor costs an array.
PIECE = 32
#: Words of a run that marks a text which shares it with another, and of a piece of such a run.
WORDS, WORDS_PIECE = 51, 8
#: Bytes of words that are hashed together.
CHUNK = 1 << 16
FACTOR, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Bytes of one suffix array, and different regions of one anchor beyond which they are compared string by string
#: through a shuffle instead (an array of so many would be 16 MB).
SHARD, MANY = 2 << 20, 20_000
#: Texts are searched for anchors in parts of so many bytes; positions then fit into the low bits of a hash.
PART, LOW = 2 << 20, 24
ALL = -1


# --- suffix arrays ---------------------------------------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (small unsigned numbers; its last one, 0, stands nowhere else).

    Suffixes are classed as smaller (S) or larger (L) than their successor. The leftmost S of each run start
    substrings that are sorted by inducing, named in order, and, where names repeat, sorted by their successors.
    Inducing from the sorted ones then orders all suffixes. Each bucket is induced in whole batches.
    """
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    step[-1] = 1
    after = np.where(step != 0, np.arange(n), n)
    after = np.minimum.accumulate(after[::-1])[::-1]  # where the run of equal numbers ends
    small = step[after] > 0
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(text)
    order = _induced(text, small, sizes, leftmost)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    order = order[is_leftmost[order]]
    ranks = _ranked(_names(text, leftmost, order), leftmost, n)
    return _induced(text, small, sizes, leftmost[np.argsort(ranks, kind="stable")])


def _induced(text: np.ndarray, small: np.ndarray, sizes: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes, in the order that follows from the given order of the leftmost S ones."""
    found = np.full(len(text), -1, np.int32)
    ends = np.cumsum(sizes)
    heads, used = ends - sizes, np.zeros(len(sizes), np.int64)
    by_letter = leftmost[np.argsort(text[leftmost], kind="stable")]
    seeds = np.bincount(text[leftmost], minlength=len(sizes))
    seed_at = np.cumsum(seeds) - seeds

    def spread(batch: np.ndarray, backwards: bool) -> None:
        """Put each batch member's predecessor, if of the kind sought, into its bucket, in the batch's order."""
        before = batch[batch > 0] - 1
        before = before[small[before] == backwards]
        if not len(before):
            return
        letters = text[before]
        by = np.argsort(letters, kind="stable")
        counts = np.bincount(letters, minlength=len(sizes))
        letters = letters[by]
        nth = used[letters] + np.arange(len(by)) - (np.cumsum(counts) - counts)[letters]
        found[ends[letters] - 1 - nth if backwards else heads[letters] + nth] = before[by]
        used[:] += counts

    for letter in np.flatnonzero(sizes):
        done = 0
        while done < used[letter]:
            batch = found[heads[letter] + done : heads[letter] + used[letter]]
            done = int(used[letter])
            spread(batch, False)
        spread(by_letter[seed_at[letter] : seed_at[letter] + seeds[letter]].astype(np.int32), False)
    large = used.copy()
    used[:] = 0
    found[heads[text[-1]]] = len(text) - 1
    for letter in np.flatnonzero(sizes)[::-1]:
        done = 0
        if letter == text[-1]:
            continue  # only the last suffix, which precedes all
        while done < used[letter]:
            batch = found[ends[letter] - used[letter] : ends[letter] - done][::-1]
            done = int(used[letter])
            spread(batch, True)
        spread(found[heads[letter] : heads[letter] + large[letter]][::-1], True)
    return found


def _names(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each leftmost suffix, in text order, the rank of its substring; equal substrings share it."""
    at = np.searchsorted(leftmost, order)
    lengths = np.diff(np.r_[leftmost, len(text) - 1]) + 1  # up to and with the next one
    same = lengths[at[1:]] == lengths[at[:-1]]
    left = np.flatnonzero(same)
    i = 0
    while len(left):
        a, b = order[left], order[left + 1]
        equal = text[a + i] == text[b + i]
        same[left[~equal]] = False
        i += 1
        left = left[equal]
        left = left[lengths[at[left]] > i]
    names = np.empty(len(leftmost), np.int64)
    names[at] = np.cumsum(np.r_[0, ~same]) if len(order) else 0
    return names


def _ranked(names: np.ndarray, leftmost: np.ndarray, n: int) -> np.ndarray:
    """Ranks of the string of names' suffixes: names that repeat are told apart by what follows, over ever longer
    stretches, each twice the one before."""
    ranks, reach = names, 1
    while len(ranks):
        counts = np.bincount(ranks)
        open_ = np.flatnonzero(counts[ranks] > 1)
        if not len(open_):
            break
        later = np.full(len(open_), -1)
        inside = open_ + reach < len(ranks)
        later[inside] = ranks[open_[inside] + reach]
        by = np.lexsort((later, ranks[open_]))
        first, then = ranks[open_][by], later[by]
        new_group = np.r_[True, first[1:] != first[:-1]]
        # within an old group, ranks go up by the number of members before
        begin = np.maximum.accumulate(np.where(new_group, np.arange(len(by)), 0))
        changed = np.r_[True, (first[1:] != first[:-1]) | (then[1:] != then[:-1])]
        start = np.maximum.accumulate(np.where(changed, np.arange(len(by)), 0))
        if reach == 1:  # from dense names to ranks that leave room for a group's members
            base = np.cumsum(counts) - counts
            ranks = base[ranks]
            first = base[first]
        fresh = ranks.copy()
        fresh[open_[by]] = first + (start - begin)
        ranks, reach = fresh, reach * 2
    return ranks


def repeated(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` numbers from each position also start elsewhere; 0 ends the text, 1 parts regions."""
    n = len(text)
    order = suffix_array(text)
    before = np.full(n, -1, np.int64)  # the suffix before each one in the order
    before[order[1:]] = order[:-1]
    common = _common_prefixes(text, before, length)
    hit = common >= length
    out = np.zeros(n, bool)
    out[hit] = True
    out[before[hit]] = True
    return out


def _common_prefixes(text: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes up to ``most``: of each position's suffix and the one before it in the order.

    Position i has at least the value at i - d, less d; so few positions start from nothing, and each later level
    of positions goes on from a bound. Eight numbers are compared at once.
    """
    n = len(text)
    padded = np.r_[text.astype(np.uint8), np.zeros(most + 16, np.uint8)]
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    out = np.zeros(n, np.int32)

    def extend(at: np.ndarray) -> None:
        at = at[before[at] >= 0]
        while len(at):
            a, b = at + out[at], before[at] + out[at]
            ok = (a < n) & (b < n)
            at, a, b = at[ok], a[ok], b[ok]
            differ = words[a] ^ words[b]
            equal = differ == 0
            rest = differ[~equal]
            low = (rest & (~rest + np.uint64(1))).astype(np.float64)  # a power of two, exactly
            out[at[~equal]] += (np.log2(low).astype(np.int32) // 8) if len(rest) else 0
            out[at[equal]] += 8
            at = at[equal]
            at = at[out[at] < most]

    stride = 64
    extend(np.arange(0, n, stride))
    while stride > 1:
        half = stride // 2
        at = np.arange(half, n, stride)
        out[at] = np.maximum(out[at - half] - half, 0)
        extend(at)
        stride = half
    return out


# --- anchors and regions ---------------------------------------------------------------------------------------


def regions(texts: Iterable[bytes], length: int = LENGTH, unit: int = 1) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, start, stop, anchor, hash) of every region: its strings start at start ... stop - length.

    All are counted in units: bytes, or words by their ``word_hashes`` of 8 bytes each (``unit`` 8).
    """
    batch: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(texts):
        for base in range(0, max(1, len(text) // unit - length + 1), PART):
            part = text[base * unit : (base + PART + length - 1) * unit]
            units = len(part) // unit
            if units < length:
                continue
            if size + units > PART and batch:
                yield from _regions(batch, length, unit)
                batch, size = [], 0
            batch.append((row, base, part))
            size += units
    if batch:
        yield from _regions(batch, length, unit)


def _regions(batch: list[tuple[int, int, bytes]], length: int, unit: int) -> Iterator[tuple[int, int, int, int, int]]:
    whole = b"".join(part for _, _, part in batch)
    sizes = np.array([len(part) // unit for _, _, part in batch])
    offsets = np.cumsum(sizes) - sizes
    piece = 1 << (min(PIECE if unit == 1 else WORDS_PIECE, max(1, length // 2)).bit_length() - 1)
    hashes = _piece_hashes(np.frombuffer(whole, np.uint8 if unit == 1 else np.uint64), piece)
    width = length - piece + 1
    low = np.uint64((1 << LOW) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (_least(keys, width) & low).astype(np.int64)  # of the string at each position
    valid = np.ones(len(anchors), bool)
    for end in offsets[1:]:
        valid[end - length + 1 : end] = False  # strings that would run into the next text
    at = np.flatnonzero(valid)
    own = anchors[at]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)])
    starts, lasts = at[new], at[np.r_[new[1:], len(at)] - 1]
    which = np.searchsorted(offsets, starts, side="right") - 1
    names = hashes[own[new]].view(np.int64)
    digest = xxhash.xxh3_64_intdigest
    for w, start, stop, name in zip(which.tolist(), starts.tolist(), (lasts + length).tolist(), names.tolist()):
        row, base, _ = batch[w]
        shift = base - int(offsets[w])
        yield row, start + shift, stop + shift, name, digest(whole[start * unit : stop * unit]) - (1 << 63)


def _piece_hashes(data: np.ndarray, piece: int) -> np.ndarray:
    """Mixed polynomial hash of the ``piece`` bytes or words at each position; ``piece`` is a power of two."""
    out, span = data.astype(np.uint64) + np.uint64(1), 1
    while span < piece:
        out = out[:-span] * np.uint64(pow(FACTOR, span, 1 << 64)) + out[span:]
        span *= 2
    return _mixed(out)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(MIX)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def word_hashes(texts: Iterable[bytes]) -> Iterator[bytes]:
    """For each text, a hash of 8 bytes for each of its words (parts without ASCII white space).

    A word's hash is a polynomial, taken from running sums over ``CHUNK`` bytes; a word cut in two is put together.
    """
    in_word = np.ones(256, bool)
    in_word[list(SPACE_BYTES)] = False
    powers, inverses = (np.cumprod(np.r_[np.uint64(1), np.full(CHUNK - 1, f, np.uint64)]) for f in (FACTOR, pow(FACTOR, -1, 1 << 64)))
    for text in texts:
        found = []
        value, length = 0, 0  # of the word that the chunk before ends in
        for base in range(0, len(text), CHUNK):
            data = np.frombuffer(text, np.uint8, min(CHUNK, len(text) - base), base)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
            inside = np.zeros(len(data) + 2, bool)
            inside[1:-1] = in_word[data]
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            starts, stops = edges[::2], edges[1::2]
            hashes = (sums[stops] - sums[starts]) * inverses[starts]
            if length and inside[1]:
                hashes[0] = (value + pow(FACTOR, length, 1 << 64) * int(hashes[0])) % (1 << 64)
            elif length:
                hashes = np.r_[np.uint64(value), hashes]
            before, length = length, 0
            if inside[-2] and base + CHUNK < len(text):
                value, length = int(hashes[-1]), int(stops[-1] - starts[-1])
                length += before if length == len(data) else 0
                hashes = hashes[:-1]
            found.append(hashes)
        yield _mixed(np.concatenate(found)).tobytes() if found else b""


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours: from the minima up to and from the bounds of blocks."""
    n = len(values)
    blocks = np.full((-(-n // width), width), np.iinfo(values.dtype).max, values.dtype)
    blocks.ravel()[:n] = values
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[: n - width + 1], upto[width - 1 : n])


# --- Spark -----------------------------------------------------------------------------------------------------


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def found_regions(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, anchor, region, n: how often a text holds a region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[int, int, int], int] = {}
            for row, _, _, anchor, region in regions([_bytes(t) for t in batch.column("text").to_pylist()], length):
                counts[row, anchor, region] = counts.get((row, anchor, region), 0) + 1
            keys = np.array(list(counts), np.int64).reshape(-1, 3)
            columns = [batch.column("doc_id").take(pa.array(keys[:, 0])), pa.array(keys[:, 1]), pa.array(keys[:, 2]), pa.array(list(counts.values()), pa.int64())]
            yield pa.record_batch(columns, ["doc_id", "anchor", "region", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, anchor long, region long, n long")


def found_passages(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, row, anchor, region: the different regions of ``words`` words in each text; row is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = [_bytes(t) for t in batch.column("text").to_pylist()]
            own = np.array([digest(t) - (1 << 63) for t in texts], np.int64)
            keys = np.array(list({(row, anchor, region) for row, _, _, anchor, region in regions(word_hashes(texts), words, 8)}), np.int64).reshape(-1, 3)
            keys = keys[np.argsort(keys[:, 0], kind="stable")]
            columns = [batch.column("doc_id").take(pa.array(keys[:, 0])), pa.array(own[keys[:, 0]]), pa.array(keys[:, 1]), pa.array(keys[:, 2])]
            yield pa.record_batch(columns, ["doc_id", "row", "anchor", "region"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, row long, anchor long, region long")


def _region_texts(docs: DataFrame, wanted: DataFrame, length: int, words: int) -> DataFrame:
    """The regions in ``wanted`` (doc_id, anchor, region, and many, or row and several), each from one document: data, or
    the hashes of a region's runs of ``words`` words where a row is named."""
    named = F.struct("anchor", "region", "many", "row", "several")
    asked = wanted.groupBy("doc_id").agg(F.collect_list(named).alias("asked")).withColumnRenamed("doc_id", "__id")
    joined = docs.select("doc_id", "text").join(asked.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(asked["__id"])).select("doc_id", "text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = [_bytes(t) for t in batch.column("text").to_pylist()]
            todo: list[dict] = [{} for _ in texts]
            passages: list[dict] = [{} for _ in texts]
            for i, asked in enumerate(batch.column("asked").to_pylist()):
                for a in asked:
                    (todo if a["row"] is None else passages)[i][a["anchor"], a["region"]] = a
            rows = []
            for row, start, stop, anchor, region in regions((t if todo[i] else b"" for i, t in enumerate(texts)), length):
                a = todo[row].pop((anchor, region), None)
                if a is not None:
                    rows.append((row, anchor, region, a["many"], texts[row][start:stop], None, None, None))
            asking = [i for i, own in enumerate(passages) if own]
            hashes = list(word_hashes(texts[i] for i in asking))
            for at, start, stop, anchor, region in regions(hashes, words, 8):
                a = passages[asking[at]].pop((anchor, region), None)
                if a is not None:
                    runs = [digest(hashes[at][8 * i : 8 * (i + words)]) - (1 << 63) for i in range(start, stop - words + 1)]
                    rows.append((asking[at], anchor, region, None, None, a["row"], a["several"], runs))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds) if i]
            yield pa.record_batch([batch.column("doc_id").take(pa.array([r[0] for r in rows], kinds[0])), *columns], names)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))
    names = ["doc_id", "anchor", "region", "many", "data", "row", "several", "runs"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, anchor long, region long, many boolean, data binary, row long, several boolean, runs array<long>")


def _shards(batches: Iterator[pa.RecordBatch], length: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated starts of each region, from regions sorted by anchor; whole anchors share a suffix array."""

    def solved(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(d) for _, _, d in held])
        text = np.zeros(int(lengths.sum()) + len(held) + 1, np.uint16)
        at = np.cumsum(lengths + 1) - lengths - 1
        # bytes 0 and 1 give way to values that UTF-8 never has, so that 0 can end the text and 1 part the regions
        data = np.frombuffer(b"\x01".join(d for _, _, d in held) + b"\x01", np.uint8)
        kept = np.ones(len(data), bool)
        kept[at + lengths] = False
        text[:-1] = np.where(kept & (data == 0), 0xFE, np.where(kept & (data == 1), 0xFF, data))
        inside = np.arange(len(data)) + length <= np.repeat(at + lengths, lengths + 1)  # the string ends in its region
        hits = repeated(text, length)[: len(data)] & inside
        edges = np.flatnonzero(np.diff(np.r_[False, hits, False].astype(np.int8))).reshape(-1, 2)
        which = np.searchsorted(at, edges[:, 0], side="right") - 1
        names = np.array([(a, r) for a, r, _ in held], np.int64)[which].reshape(-1, 2)
        columns = [names[:, 0], names[:, 1], edges[:, 0] - at[which], edges[:, 1] - at[which]]
        return pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["anchor", "region", "first", "stop"])

    held: list[tuple[int, int, bytes]] = []
    total, last = 0, None
    for batch in batches:
        for anchor, region, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "region", "data"))):
            if last == (anchor, region):
                continue
            if last and last[0] != anchor and total > size:
                yield solved(held)
                held, total = [], 0
            held.append((anchor, region, data))
            total += len(data)
            last = anchor, region
    if held:
        yield solved(held)


def _by_string(texts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many regions: the strings are counted by their 128-bit hashes in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for anchor, region, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "region", "data"))):
                n = len(data) - length + 1
                hashes = [digest(data[i : i + length]) for i in range(n)]
                columns = [pa.array([anchor] * n, pa.int64()), pa.array([region] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(hashes, pa.binary())]
                yield pa.record_batch(columns, ["anchor", "region", "first", "string"])

    strings = stored(texts.mapInArrow(run, "anchor long, region long, first long, string binary"), "suffix-strings")
    twice = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    return strings.join(twice, "string").select("anchor", "region", "first", (F.col("first") + 1).alias("stop"))


def repeats(docs: DataFrame, *, length: int = LENGTH, shard: int = SHARD, many: int = MANY, words: int = WORDS) -> DataFrame:
    """doc_id, marks, passages: for each document with repeats, the runs of repeated strings in its regions, and the
    hashes of those of its texts that share ``words`` words in a row with another row.

    marks is an array of (anchor, region, first, stop): strings first ... stop - 1 of the region repeat; ``ALL`` as
    first means every one.
    """
    found = stored(found_regions(docs, length), "suffix-regions")
    counted = found.groupBy("anchor", "region").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"))
    counted = stored(
        counted.join(counted.groupBy("anchor").agg(F.count("*").alias("different"), F.sum("n").alias("whole")).where("whole > 1"), "anchor").drop("whole"),
        "suffix-counted",
    )
    alike = counted.where("n > 1").select("anchor", "region", F.lit(ALL).cast("long").alias("first"), F.lit(ALL).cast("long").alias("stop"))
    met = stored(_met(stored(found_passages(docs, words), "suffix-passages")), "suffix-met")
    held = met.where("mixed").groupBy("anchor", "region").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("row").alias("row"))
    wanted = counted.where("different > 1").select("doc_id", "anchor", "region", (F.col("different") > many).alias("many"), F.lit(None).cast("long").alias("row"), F.lit(None).cast("boolean").alias("several"))
    wanted = wanted.union(held.select("doc_id", "anchor", "region", F.lit(None).cast("boolean"), "row", F.col("n") > 1))
    texts = stored(_region_texts(docs, wanted, length, words), "suffix-texts")
    strings = texts.where("row IS NULL").select("anchor", "region", "many", "data")
    dealt = strings.where("NOT many").repartition("anchor").sortWithinPartitions("anchor", "region")
    runs = dealt.mapInArrow(lambda batches: _shards(batches, length, shard), "anchor long, region long, first long, stop long")
    if not strings.where("many").isEmpty():
        runs = runs.union(_by_string(strings.where("many"), length))
    marks = alike.union(runs)
    shared = met.where("NOT mixed").select("doc_id", "row").union(_across(met.where("mixed"), held, texts.where("row IS NOT NULL")))
    each = found.select("doc_id", "anchor", "region").join(marks, ["anchor", "region"])
    each = each.select("doc_id", F.struct("anchor", "region", "first", "stop").alias("mark"), F.lit(None).cast("long").alias("row"))
    each = each.unionByName(shared.distinct(), allowMissingColumns=True)
    return each.groupBy("doc_id").agg(F.collect_list("mark").alias("marks"), F.collect_list("row").alias("passages"))


def _met(found: DataFrame) -> DataFrame:
    """The regions of words whose anchor stands in another row or another region too; mixed: in different regions."""
    anchors = found.groupBy("anchor").agg(F.count("*").alias("rows"), F.min("region").alias("least"), F.max("region").alias("most"))
    return found.join(anchors.where("rows > 1").select("anchor", (F.col("least") != F.col("most")).alias("mixed")), "anchor")


def _across(met: DataFrame, held: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id, row of the rows that share a whole region, or else one run out of it, with another row."""
    whole = met.join(held.where("n > 1").select("anchor", "region"), ["anchor", "region"]).select("doc_id", "row")
    runs = texts.select("doc_id", "row", "several", "anchor", F.explode("runs").alias("run"))
    twice = runs.groupBy("anchor", "run").agg(F.min("row").alias("least"), F.max("row").alias("most"), F.max("several").alias("several"))
    twice = twice.where("several OR least != most").select("anchor", "run")
    return whole.union(runs.where("NOT several").join(twice, ["anchor", "run"]).select("doc_id", "row"))


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_bytes, spans (start, stop in bytes) and shares of every row of ``docs``.

    Each byte goes that lies in a string of ``length`` bytes (of the text in UTF-8) which starts anywhere else too, in
    this or another document. Null and empty texts have no bytes. Repeated rows are documents of their own, so
    long ones vanish altogether; null doc_ids are treated like one more value. Columns other than doc_id and text
    are ignored. ``shares`` is true if ``words`` words of the text in a row stand in another row's text too, whatever
    white space parts them and however few bytes they have; a passage that only its own text repeats doesn't count.
    """
    length = options.get("length", LENGTH)
    marked = repeats(docs, **options).withColumnRenamed("doc_id", "__id")
    joined = docs.select("doc_id", "text").join(marked.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(marked["__id"]), "left").drop("__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = [_bytes(t) for t in batch.column("text").to_pylist()]
            shares = [bool(own) and digest(t) - (1 << 63) in own for t, own in zip(texts, batch.column("passages").to_pylist())]
            marks: list[dict] = []
            for own in batch.column("marks").to_pylist():
                marks.append({})
                for m in own or ():
                    marks[-1].setdefault((m["anchor"], m["region"]), []).append((m["first"], m["stop"]))
            gone: list[list[tuple[int, int]]] = [[] for _ in texts]
            for row, start, stop, anchor, region in regions([t if m else b"" for t, m in zip(texts, marks)], length):
                for first, end in marks[row].get((anchor, region), ()):
                    gone[row].append((start, stop) if first == ALL else (start + first, start + end - 1 + length))
            spans = [_merged(g) for g in gone]
            kept = []
            for text, own in zip(texts, spans):
                edges = [0, *(x for span in own for x in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            numbers = [(len(t), sum(b - a for a, b in s), len(s)) for t, s in zip(texts, spans)]
            columns = [batch.column("doc_id"), *(pa.array([x[i] for x in numbers], pa.int64()) for i in range(3))]
            columns += [pa.array(kept, pa.binary()), pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], span_type), pa.array(shares, pa.bool_())]
            yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "spans", "shares"])

    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_bytes binary, spans array<struct<start:long,stop:long>>, shares boolean")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out

