"""Licence notices by conditional compression.

Sentences that mention a licence are candidate blocks, adjoining ones together. A block is compressed on its own and once
with each template as raw zstandard dictionary, which ranks the templates by the bytes they save. In that order each one is
aligned with the place in the block that it fits best, and the first whose exact differences in wording allow it is the
confirmed winner. What lies before and after that place is judged again, so a block may hold several notices.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Usual wordings of licence notices, by SPDX identifier.
TEMPLATES = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", 'Licensed under the "Simplified" BSD License.'],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC-BY-SA-3.0": ["Licensed under CC BY-SA 3.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal Public Domain Dedication."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.',
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: A sentence with one of these is a candidate.
HINT = r"(?i)licen[cs]e|copyright|redistribut|public\s+domain|creative\s+commons|\bCC[ -]BY|\bCC0\b|permission\s+is\s+hereby|permission\s+to\s+use"
#: Where sentences end: at . ! ? before a space, but not after a single letter ("v. 2.0"), and at empty lines.
SENTENCE = r"(?<!\b[A-Za-z])[.!?](?=\s)|\n[ \t\r]*(?=\n)"
#: Where reported blocks may end, too.
PIECE = r"\n|[.!?](?=\s)"
WORD = r"\w+(?:[.-]\w+)*"
#: A version number, and one that goes on from the end of a notice; years aren't.
VERSION = r"v?\d{1,3}(?:\.\d+)*"
GOES_ON = rf"[ \t,(]*(?:version[ \t]+|v\.?[ \t]*)?(?:{VERSION})(?![\w-])"
#: A winner must save this share of its own compressed bytes, and differ by no more than this share of words. Wordings of
#: fewer words than ``SHORT`` must be there whole.
LEAST_SAVED, MOST_DIFFERENT, SHORT = 0.3, 0.25, 12
#: Verdicts on blocks of at most so many characters are remembered, and so many of them.
REMEMBERED_CHARACTERS, REMEMBERED = 2_000, 4_000
COLUMNS = (
    "doc_id {kind}, start long, stop long, block string, license string, plain_bytes long, template_bytes long, saved double, "
    "runner_up string, runner_up_saved double, missing array<string>, extra array<string>, confirmed boolean"
)


def blocks(text: str, reach: int) -> Iterator[tuple[int, int]]:
    """Start and stop of each run of adjoining sentences with a hint; of a longer sentence only what lies within ``reach``
    words of a hint."""
    hints = [m.start() for m in re.finditer(HINT, text)]
    edges = [0, *(m.end() for m in re.finditer(SENTENCE, text)), len(text)] if hints else []
    run: tuple[int, int] | None = None
    at = 0
    while at < len(hints):
        nth = bisect_right(edges, hints[at], hi=len(edges) - 1) - 1
        a, b = edges[nth], edges[nth + 1]
        after = bisect_left(hints, b, at)
        places = [m.span() for m in re.finditer(WORD, text[a:b])]
        starts = [a + p[0] for p in places]
        for hint in hints[at:after]:
            word = bisect_right(starts, hint) - 1
            low = a if word - reach <= 0 else starts[word - reach]
            high = b if word + reach >= len(places) - 1 else a + places[word + reach][1]
            if run and (low <= run[1] or not text[run[1] : low].strip()):
                run = run[0], max(run[1], high)
            else:
                if run:
                    yield run
                run = low, high
        at = after
    if run:
        yield run


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def fits(template: list[str], block: list[str], most: float) -> Iterator[tuple[int, int, list[str], list[str]]]:
    """Places of the block (first word, word after the last) that differ from the whole template by at most ``most`` words
    missing or extra, the closest first, with these words. Memory: the template's words times the block's."""
    n = len(block)
    steps = np.arange(n + 1)
    cost = np.zeros((len(template) + 1, n + 1), np.int32)
    ids = {w: i for i, w in enumerate(dict.fromkeys(block))}
    own = np.array([ids[w] for w in block], np.int32)
    for i, word in enumerate(template, 1):
        row = cost[i - 1] + 1
        row[1:] = np.where(own == ids.get(word, -1), np.minimum(row[1:], cost[i - 1, :-1]), row[1:])
        cost[i] = np.minimum.accumulate(row - steps) + steps
    ends = np.flatnonzero(cost[-1] <= most)
    for end in ends[np.argsort(cost[-1, ends], kind="stable")].tolist():
        i, j, missing, extra = len(template), end, [], []
        while i:
            if j and template[i - 1] == block[j - 1] and cost[i, j] == cost[i - 1, j - 1]:
                i, j = i - 1, j - 1
            elif cost[i, j] == cost[i - 1, j] + 1:
                i -= 1
                missing.append(template[i])
            else:
                j -= 1
                extra.append(block[j])
        if j < end:
            yield j, end, missing[::-1], extra[::-1]


@dataclass
class Template:
    name: str
    wording: str
    words: list[str]
    packer: zstandard.ZstdCompressor


@dataclass
class Verdict:
    """A block's best template; if confirmed, start and stop of its place there, whose bytes and differences these are."""

    license: str
    start: int
    stop: int
    plain_bytes: int
    template_bytes: int
    runner_up: str | None
    runner_up_saved: float | None
    missing: list[str]
    extra: list[str]
    confirmed: bool

    def row(self) -> tuple:
        saved = (self.plain_bytes - self.template_bytes) / self.plain_bytes
        return self.license, self.plain_bytes, self.template_bytes, saved, self.runner_up, self.runner_up_saved, self.missing, self.extra, self.confirmed


class Scanner:
    """Finds and judges blocks; the verdict of a block that repeats is remembered."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, level: int = 9):
        frame = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
        self.alone = zstandard.ZstdCompressor(level=level, **frame)
        self.templates = [
            Template(name, wording, words(wording), zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(plain(wording).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **frame))
            for name, wordings in sorted(templates.items()) for wording in wordings
        ]
        #: No notice has more words than this.
        self.reach = int(max(len(t.words) for t in self.templates) * (1 + MOST_DIFFERENT)) + 1
        self.telling = self._telling()
        self._known = lru_cache(maxsize=REMEMBERED)(self._verdict)

    def _telling(self) -> set[str]:
        """The words in which similar wordings of different licences differ."""
        found: set[str] = set()
        for i, one in enumerate(self.templates):
            for other in self.templates[:i]:
                if one.name != other.name:
                    missing, extra = differences(one.words, other.words)
                    if len(missing) + len(extra) <= MOST_DIFFERENT * (len(one.words) + len(other.words)):
                        found.update(missing, extra)
        return found

    def verdict(self, block: str) -> Verdict:
        return self._known(block) if len(block) <= REMEMBERED_CHARACTERS else self._verdict(block)

    def judge(self, block: str) -> tuple:
        return self.verdict(block).row()

    def _sizes(self, block: str) -> tuple[int, list[int]]:
        data = plain(block).encode("utf-8", "surrogatepass")
        return len(self.alone.compress(data)), [len(t.packer.compress(data)) for t in self.templates]

    def _verdict(self, block: str) -> Verdict:
        size, packed = self._sizes(block)
        # the greatest saving first, then the shortest wording and the name
        ranked = sorted(range(len(packed)), key=lambda i: (packed[i], len(self.templates[i].wording), self.templates[i].name))
        spans = [m.span() for m in re.finditer(WORD, block)]
        own = [block[a:b].lower() for a, b in spans]
        bag = set(own)
        for i in ranked:
            template = self.templates[i]
            most = MOST_DIFFERENT * len(template.words)
            if packed[i] >= size or sum(w not in bag for w in template.words) > most:
                continue
            for first, last, missing, extra in fits(template.words, own, most):
                a, b = spans[first][0], spans[last - 1][1]
                if self._agree(template, missing, extra, block[b : b + 100]):
                    whole, parts = self._sizes(block[a:b])
                    if whole - parts[i] >= LEAST_SAVED * whole:
                        return Verdict(template.name, a, b, whole, parts[i], *self._second(template.name, whole, parts), missing, extra, True)
        best = self.templates[ranked[0]]
        return Verdict(best.name, 0, len(block), size, packed[ranked[0]], *self._second(best.name, size, packed), *differences(best.words, own), False)

    def _second(self, name: str, size: int, packed: list[int]) -> tuple[str | None, float | None]:
        others = [(n, len(t.wording), t.name) for n, t in zip(packed, self.templates) if t.name != name]
        return (min(others)[2], (size - min(others)[0]) / size) if others else (None, None)

    def _agree(self, template: Template, missing: list[str], extra: list[str], after: str) -> bool:
        """Names and versions must agree whatever the share: no word that tells licences apart may differ, no number be
        lost, no version be added within or at the end."""
        if missing and len(template.words) < SHORT or any(c.isdigit() for w in missing for c in w):
            return False
        if any(w in self.telling for w in (*missing, *extra)) or any(re.fullmatch(VERSION, w) for w in extra):
            return False
        return not re.match(GOES_ON, after, re.I)

    def notices(self, text: str) -> Iterator[tuple[int, int, Verdict]]:
        """Start, stop and verdict of all blocks of a text, in order."""
        edges = None
        for a, b in blocks(text, self.reach):
            edges = edges or [0, *(m.end() for m in re.finditer(PIECE, text)), len(text)]
            yield from self._judged(text, a, b, [a + m.start() for m in re.finditer(WORD, text[a:b])], edges)

    def _judged(self, text: str, a: int, b: int, starts: list[int], edges: list[int]) -> Iterator[tuple[int, int, Verdict]]:
        """The blocks of a run, seen through windows of three times the longest notice, so the time is linear."""
        hint = re.compile(HINT)
        while a < b:
            at = bisect_left(starts, a)
            end = min(b, starts[at + 3 * self.reach]) if at + 3 * self.reach < len(starts) else b
            found = self.verdict(text[a:end])
            if found.confirmed:
                start, stop = a + found.start, a + found.stop
                low, high = max(a, edges[bisect_right(edges, start) - 1]), min(b, edges[bisect_left(edges, stop)])
                low, high = start if hint.search(text, low, start) else low, stop if hint.search(text, stop, high) else high
                yield from self._judged(text, a, low, starts, edges)
                yield low, high, found
                a = high
                continue
            if end < b:  # a notice that goes on beyond the window starts in its last third
                end = starts[at + 2 * self.reach]
                piece = edges[bisect_right(edges, end) - 1]
                end = piece if piece > starts[at + self.reach] else end
                found = self.verdict(text[a:end])
            if hint.search(text, a, end):
                yield a, end, found
            a = end


def differences(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """The template's words that the block lacks, and the block's that the template lacks, in order."""
    missing, extra = [], []
    for kind, a, b, c, d in SequenceMatcher(None, template, block, autojunk=False).get_opcodes():
        if kind != "equal":
            missing += template[a:b]
            extra += block[c:d]
    return missing, extra


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per candidate block of every whole text of ``docs``: its place, the confirmed template or else the one that
    saves most, the runner-up among the other licences, and the exact differences in wording. A confirmed row's bytes
    are those of the notice itself.

    Texts without a hint, null and empty ones give no row, an empty table none. Very long texts are judged whole, in
    windows. Of templates that save equally the one with the shortest wording goes first, then the smaller name; of
    equally close places the first. Repeated rows give repeated results, null doc_ids too. Columns other than doc_id
    and text are ignored.
    """
    hinted = docs.select("doc_id", "text").where(F.col("text").rlike(HINT))
    kind = docs.schema["doc_id"].dataType.simpleString()
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_()]
    names = ["doc_id", *(c.split()[0] for c in COLUMNS.split(", ")[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for a, b, verdict in scanner.notices(text):
                    rows.append(row)
                    found.append((a, b, text[a:b].rstrip("\n"), *verdict.row()))
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            columns += [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
            yield pa.record_batch(columns, names)

    return hinted.mapInArrow(run, COLUMNS.format(kind=kind))
