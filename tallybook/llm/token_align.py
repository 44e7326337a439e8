"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which of them overlap.

Both token sequences of a text cover the same bytes. Interval coalescing cuts them into groups: all tokens of both
sides are sorted by where they start, a running maximum of the ends is taken, and a group breaks where a token starts
at or behind that maximum. Within the groups every overlapping pair of tokens is a link. Corpus-wide, a pair of ids
counts the documents that hold it linked.

Neither tokenizer looks across a single space between two other characters (byte-level BPE splits there by its
pattern, and no sentence piece goes on behind a letter with a space), so texts are cut there, and each distinct part
is tokenized and coalesced once per task as long as it is remembered. Offsets of a text's parts add up.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tallybook.llm.common import stored

#: A space at which neither tokenizer joins what is before and behind it.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: The sign that stands for a space in sentence pieces; in a text it is lost.
MARK = "▁"
#: What follows a token in the groups' text: one of its side, one of the other side, the next group, the next part.
SIGNS = ",|;\n"
SAME, OTHER, NEXT, END = range(4)
#: Bytes, about, of parts that a task remembers, and characters of texts that it handles at once (a longer text alone).
ROOM, CHUNK = 120_000_000, 2_000_000
#: A table of at most this many pairs of ids (some 100 bytes each when joined) goes to every executor; a larger one is
#: joined by a shuffle.
SPREAD_PAIRS = 1_000_000


class ByteBpe:
    """A byte-level BPE file in the format of the ``tokenizers`` library: ids of texts, and the bytes of each id.

    Its merges must be numbered in their order, as they are in files trained so; ranks are then ids, which
    ``tiktoken`` takes. Special tokens are plain text.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(b): b for b in plain}  # the printable bytes stand for themselves, the others follow from 256 on
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"] for t in held["added_tokens"] if t["special"]}
        ids = {t: i for t, i in held["model"]["vocab"].items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"]]
        if [ids["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError(f"the merges of {path} are not in the order of their ids")
        self.bytes = [b""] * (1 + max(held["model"]["vocab"].values()))
        for token, number in ids.items():
            self.bytes[number] = bytes(letters[c] for c in token)
        ranks = {self.bytes[i]: i for i in ids.values()}
        self.coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of each text with a space before it."""
        return [self.coder.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """A sentencepiece model that puts a space before each text: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece} of {path} goes on behind a space")
            one = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.model.is_byte(number) else None
            self.bytes.append(bytes([int(one[1], 16)]) if one else piece.replace(MARK, " ").encode())

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two token sequences that cover the same bytes, given where their tokens end.

    Returns the group of every A and of every B token, and the links as numbers of A and of B tokens, by A token.
    Several texts may follow each other: none shares a group with the next.
    """
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]])[: len(ends)] if len(ends) else ends
    side = np.repeat([0, 1], [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    opens = np.ones(len(ends), bool)
    opens[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(opens) - 1
    n = len(a_ends)
    first = np.searchsorted(b_ends, starts[:n], side="right")
    count = np.searchsorted(starts[n:], a_ends, side="left") - first
    a = np.repeat(np.arange(n), count)
    b = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return group[:n], group[n:], a, b


class Memory:
    """Alignments of the parts of texts, by number: sizes, the groups as text, and the linked pairs of ids."""

    def __init__(self, a: ByteBpe, b: Pieces, room: int = ROOM):
        self.a, self.b, self.room = a, b, room
        self.a_length = np.array([len(x) for x in a.bytes], np.int64)
        self.b_length = np.array([len(x) for x in b.bytes], np.int64)
        self.signed = [f"{i}{sign}" for i in range(max(len(a.bytes), len(b.bytes))) for sign in SIGNS]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.used = 0
        self.groups: list[str] = []
        self.sizes: list[np.ndarray] = []  # tokens of A, tokens of B, groups; -1 where the bytes differ
        self.pairs: list[np.ndarray] = []
        self.begins: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.flat: tuple | None = None

    def learn(self, parts: list[str]) -> None:
        """Tokenize and coalesce these parts, none of which is known yet.

        Parts are put together again with single spaces, as neither tokenizer looks across, and go to it by the
        thousand; those with white space at an end are taken alone.
        """
        odd = [p for p in parts if p[0].isspace() or p[-1].isspace()]
        if odd:
            apart = set(odd)
            parts = [p for p in parts if p not in apart]
        together = [parts[i : i + 2000] for i in range(0, len(parts), 2000)]
        self._learn([[p] for p in odd])
        self._learn(together)

    def _learn(self, together: list[list[str]]) -> None:
        texts = [" ".join(parts) for parts in together]
        a_ids, b_ids = self.a.encode(texts), self.b.encode(texts)
        again: list[list[str]] = []
        for k, text in enumerate(texts):
            raw = b" " + text.encode()
            if b"".join(map(self.a.bytes.__getitem__, a_ids[k])) != raw or b"".join(map(self.b.bytes.__getitem__, b_ids[k])) != raw:
                if len(together[k]) > 1:
                    again += [[p] for p in together[k]]
                    together[k] = []
                a_ids[k], b_ids[k] = [], []
        parts = list(chain.from_iterable(together))
        if parts:
            a = np.fromiter(chain.from_iterable(a_ids), np.int64)
            b = np.fromiter(chain.from_iterable(b_ids), np.int64)
            size = np.fromiter((len(p.encode()) + 1 for p in parts), np.int64, len(parts))
            bad = np.repeat([not ids for ids in a_ids], [len(own) for own in together])
            size[bad] = 0
            self._keep(parts, bad, np.cumsum(size), a, b)
        if again:
            self._learn(again)

    def _keep(self, parts: list[str], bad: np.ndarray, part_ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Coalesce the tokens of parts that end at these bytes, and remember what comes of it by part."""
        a_ends, b_ends = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        in_a, in_b, link_a, link_b = coalesce(a_ends, b_ends)
        until = [np.searchsorted(ends, part_ends, side="right") for ends in (a_ends, b_ends)]
        n_a, n_b = (np.diff(x, prepend=0) for x in until)
        group_end = np.r_[0, in_a + 1][until[0]]
        self.sizes.append(np.where(bad[:, None], -1, np.stack([n_a, n_b, np.diff(group_end, prepend=0)], axis=1)))
        self.pairs.append(a[link_a] * len(self.b.bytes) + b[link_b])
        ends = np.searchsorted(link_a, until[0])
        self.begins.append(self.begins[-1][-1] + ends)
        # the groups' text: all tokens by group, A's first, each with the sign that follows it
        group, side = np.r_[in_a, in_b], np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        number, group, side = np.r_[a, b][order], group[order], side[order]
        sign = np.full(len(group), END)
        sign[:-1] = np.where(group[1:] != group[:-1], NEXT, np.where(side[1:] != side[:-1], OTHER, SAME))
        sign[(until[0] + until[1])[~bad] - 1] = END
        texts = "".join(map(self.signed.__getitem__, (4 * number + sign).tolist())).split("\n")
        found = iter(texts)
        own = [next(found) if n else "" for n in n_a.tolist()]
        self.known.update(zip(parts, range(len(self.groups), len(self.groups) + len(parts)), strict=True))
        self.groups += own
        # a part costs its own text, its groups' text, and some 200 bytes beside
        self.used += sum(map(len, parts)) + sum(map(len, own)) + 200 * len(parts) + 8 * len(link_a)

    def flattened(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes by part, and all pairs with where each part's begin."""
        for parts in (self.sizes, self.pairs, self.begins):
            parts[:] = [np.concatenate(parts)]
        return self.sizes[0], self.pairs[0], self.begins[0]

    def align(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: its sizes and its groups; and of all texts their distinct pairs, how often each is linked, and
        where each text's end."""
        if self.used > self.room:
            self.forget()
        parts = [CUT.split(t) if t and MARK not in t else [] for t in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(parts)) if p not in self.known]
        if new:
            self.learn(new)
            self.flat = None
        if not self.groups:
            return np.zeros((len(texts), 3), np.int64), [""] * len(texts), (np.zeros(0, np.int64),) * 2 + (np.zeros(len(texts), np.int64),)
        self.flat = self.flat or self.flattened()
        sizes, pairs, begin = self.flat
        numbers = [np.fromiter(map(self.known.__getitem__, own), np.int64, len(own)) for own in parts]
        numbers = [x if not len(x) or sizes[x, 0].min() >= 0 else x[:0] for x in numbers]
        total = np.array([sizes[x].sum(axis=0) for x in numbers], np.int64).reshape(-1, 3)
        groups = [";".join(map(self.groups.__getitem__, x.tolist())) for x in numbers]
        # distinct parts of each text, then their pairs, then distinct pairs
        key = np.repeat(np.arange(len(texts)), [len(x) for x in numbers]) * len(self.groups) + np.concatenate(numbers)
        key, times = np.unique(key, return_counts=True)
        text, part = np.divmod(key, len(self.groups))
        count = begin[part + 1] - begin[part]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[part], count)
        shift = len(self.a.bytes) * len(self.b.bytes)
        key, back = np.repeat(text, count) * shift + pairs[at], np.repeat(times, count)
        order = np.argsort(key)
        key, back = key[order], back[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key
        linked = np.add.reduceat(back, first) if len(key) else back
        text, pair = np.divmod(key[first], shift)
        return total, groups, (pair, linked, np.searchsorted(text, np.arange(len(texts)), side="right"))


def chunks(texts: Sequence[str | None], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` characters together."""
    begin = held = 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield begin, k + 1
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def aligned(docs: DataFrame, path_a: str, path_b: str, *, text: bool = False) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, groups_sha256 and pairs (pair, n) of each document, from one pass over the texts.

    ``row`` numbers the rows; ``pair`` is A's id times the size of B's vocabulary plus B's id, and n how often the text
    links it. With ``text`` the groups themselves are in ``groups``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(ByteBpe(path_a), Pieces(path_b))
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for begin, end in chunks(texts):
                total, groups, (pair, linked, ends) = memory.align(texts[begin:end])
                offsets = pa.array(np.r_[0, ends].astype(np.int32))
                links = pa.StructArray.from_arrays([pa.array(pair), pa.array(linked.astype(np.int32))], ["pair", "n"])
                batch = whole.slice(begin, end - begin)
                columns = [batch.column("row"), batch.column("doc_id"), *(pa.array(total[:, i]) for i in range(3))]
                columns.append(pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]))
                columns.append(pa.ListArray.from_arrays(offsets, links))
                yield pa.record_batch([*columns, *([pa.array(groups)] if text else [])], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", *["groups"] * text]
    schema = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<struct<pair:long,n:int>>"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema + ", groups string" * text)


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """a, b, pair, docs (documents that link it), best (no pair of this A id is in more): one row per pair of ids.

    Counts are added up in each task first, so a pair that every text holds is one row from each.
    """
    counts = found.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = counts.withColumns({"a": F.expr(f"pair div {size_b}"), "b": F.expr(f"pair % {size_b}")})
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(W.partitionBy("a"))).select("a", "b", "pair", "docs", "best")


def scored(docs: DataFrame, *, path_a: str | None = None, path_b: str | None = None, text: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document (``text``: also groups).

    A is byte-level BPE over space and text, B sentence pieces over the text, to which the model adds a space. A text that is
    null, empty, or not given back by both tokenizers byte for byte has no tokens: zeros and an empty digest. Repeated
    rows and null doc_ids are documents of their own; ties for the highest count are all best. An empty table gives no
    rows. Columns other than doc_id and text are ignored. Texts of any length are taken whole, one such at a time in
    memory. The result of the one pass over the texts is stored; what is joined to it grows with the vocabularies.
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    found = stored(aligned(docs, path_a, path_b, text=text), "aligned")
    counts = stored(pair_counts(found, len(Pieces(path_b).bytes)), "pair-counts").select("pair", "docs", "best")
    if counts.count() <= SPREAD_PAIRS:
        counts = F.broadcast(counts)
    own = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", *["groups"] * text]
    links = found.select(*own, F.explode_outer("pairs").alias("link")).select(*own, "link.pair", "link.n").join(counts, "pair", "left")
    total = lambda what: F.coalesce(F.sum(what), F.lit(0)).cast("long")
    sums = links.groupBy(*own).agg(
        total("n").alias("n_links"), total(F.when(F.col("best"), F.col("n"))).alias("n_best"), total(F.col("n") * F.col("docs")).alias("count_sum")
    )
    return sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * text)
