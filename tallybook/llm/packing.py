"""Packing tokenized documents into sequences: shortest-pack-first over the histogram of lengths.

Documents are cut into pieces as they are tokenized. Only the histogram of piece lengths (at most one count per
length up to the sequence size) reaches the driver, which packs counts, not pieces: lengths are placed longest first,
each into the pattern that is shortest so far and still has room, and patterns are split where only some of their
packs take a piece. The pieces then find their pattern by their rank among the pieces of their length.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallybook.llm.common import stored

SIZE = 2048
END = 1
#: What Python's split() takes for white space and the tokenizer doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Marks that are one part with each other and none with letters before them; an apostrophe can be the start of one.
PUNCTUATION = string.punctuation.replace("'", "")
#: The pieces of a length are ranked in groups of about this many.
RANKED = 1000


class Remembered(dict):
    """What ``find`` gave for each key; emptied when it holds ``room`` keys."""

    def __init__(self, find: Callable, room: int):
        super().__init__()
        self.find, self.room = find, room

    def __missing__(self, key):
        value = self.find(key)
        if len(self) >= self.room:
            self.clear()
        self[key] = value
        return value


class WordTokens:
    """Token ids of texts, word by word with a memory, for tokenizers whose words end at white space.

    A word of letters, perhaps with ASCII punctuation behind, goes to the tokenizer's model alone, through the
    tokenizer's own normal form of each letter, and the punctuation on its own; any other word takes the whole
    tokenizer. The memory only saves work and is emptied when it holds ``room`` words.
    """

    def __init__(self, path: str, room: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = Remembered(self._word, room)
        self.tails = Remembered(self._whole, room)
        self.letters = Remembered(self._letter, room)

    def _letter(self, code: int) -> str:
        """What the model gets for a letter, by code point; a zero character if that isn't one letter's."""
        normal = self.tokenizer.normalizer.normalize_str(chr(code))
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal) if len(normal) == 1 and normal.isalpha() else []
        return parts[0][0] if len(parts) == 1 else "\0"

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        bare = word.rstrip(PUNCTUATION)
        if not bare.isalpha() or not (bare.isascii() or is_normalized("NFC", bare)):
            return self._whole(word)
        inner = bare.translate(self.letters)
        if "\0" in inner:
            return self._whole(word)
        ids = [token.id for token in self.model.tokenize(inner)]
        own = struct.pack(f"<{len(ids)}I", *ids)
        return own + self.tails[word[len(bare) :]] if len(bare) < len(word) else own

    def ids(self, text: str) -> bytes:
        """The ids as unsigned little-endian 32-bit numbers."""
        if ODD_SPACE.search(text):
            return self._whole(text)
        words = (text.lower() if text.isascii() else text).split()
        return b"".join(map(self.known.__getitem__, words))


def cut(length: int, size: int = SIZE) -> list[int]:
    """Lengths of the pieces of a document: full sequences, and what is left."""
    return [size] * (length // size) + ([length % size] if length % size else [])


def pieces(docs: DataFrame, path: str, size: int = SIZE, ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece; with ``ids`` also its ids (array of int)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(path)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows, numbers, values = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                data = tokens.ids(text or "") + end
                total, start = len(data) // 4, 0
                for length in cut(total, size):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append(row)
                    numbers.append((start, length, zlib.crc32(part), total))
                    if ids:
                        values.append(np.frombuffer(part, "<u4").astype(np.int32))
                    start += length
            table = np.array(numbers, np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(table[:, i]) for i in range(4))]
            if ids:
                columns.append(pa.array(values, pa.list_(pa.int32())))
            yield pa.record_batch(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * ids]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Pattern:
    """``count`` packs of pieces with these lengths, in order."""

    count: int
    lengths: tuple[int, ...]


def pack_histogram(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Shortest-pack-first: patterns that hold ``counts[length]`` pieces of every length, none over ``size``."""
    by_room: dict[int, list[Pattern]] = {}
    most = 0  # no pattern has more room
    done: list[Pattern] = []

    def put(pattern: Pattern, room: int) -> None:
        nonlocal most
        if room:
            by_room.setdefault(room, []).append(pattern)
            most = max(most, room)
        else:
            done.append(pattern)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while most and not by_room.get(most):
                by_room.pop(most, None)
                most -= 1
            if most < length:
                put(Pattern(left, (length,)), size - length)
                break
            old = by_room[most].pop()
            n = min(left, old.count)
            left -= n
            room = most
            if old.count > n:
                by_room[room].append(Pattern(old.count - n, old.lengths))
            put(Pattern(n, (*old.lengths, length)), room - length)
    return done + [p for room in sorted(by_room) for p in by_room[room]]


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length the places of its pieces: rows (first rank, first sequence, offset), by first rank."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern in patterns:
        offset = 0
        for length in pattern.lengths:
            found.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + pattern.count
            offset += length
        sequence += pattern.count
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def ranked(found: DataFrame, each: int = RANKED) -> DataFrame:
    """``found`` with ``rank``, from 0 among the pieces of the same length.

    A length is ranked in salted groups of about ``each`` pieces, whose counts are then added up, so one that holds
    most pieces is spread. The number of salts follows from the histogram, which has at most a row per length.
    """
    salts = found.groupBy("length").agg(F.ceil(F.count("*") / each).alias("salts"))
    salted = found.join(F.broadcast(salts), "length")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("salts"))).drop("salts")
    counted = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    return (
        salted.withColumn("inside", inside).join(counted, ["length", "salt"])
        .withColumn("rank", (F.col("earlier") + F.col("inside")).cast("long")).drop("salt", "inside", "earlier")
    )


def placed(found: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with sequence_id and offset."""
    counts = {row.length: row.n for row in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = slots(pack_histogram(counts, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                own, rows = length == one, where[int(one)]
                at = np.searchsorted(rows[:, 0], rank[own], side="right") - 1
                sequence[own] = rows[at, 1] + rank[own] - rows[at, 0]
                offset[own] = rows[at, 2]
            kept = batch.drop_columns(["rank"])
            yield pa.record_batch([*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"])

    out = ranked(found)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name != "rank")
    return out.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, *, path: str | None = None, size: int = SIZE, ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document.

    ``path``: the tokenizer's file; ``ids``: also give each piece's token ids. Null and empty texts are one piece of
    the end token. Repeated rows and null doc_ids are documents of their own. An empty table gives no pieces. Columns
    other than doc_id and text are ignored. Texts are tokenized once; the pieces are stored in between.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return placed(stored(pieces(docs, path, size, ids), "packing-pieces"), size)
