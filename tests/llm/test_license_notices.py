"""Licence notices as they stand in real texts, and all winners of the small table by brute force."""

from __future__ import annotations

import re

import duckdb
import pytest
import zstandard

from conftest import SF
from tallybook.llm import license_scan

APACHE = """Copyright 2021 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
MIT = """The MIT License (MIT)

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Copyright 2020 Foo. Released under the MIT License.", ["MIT"]),
        ("Released under the MIT License, 2020 Foo.", ["MIT"]),
        ("Released under the MIT License. Licensed under CC BY 4.0.", ["MIT", "CC-BY-4.0"]),
        ("Dual: released under the MIT License, licensed under CC BY 4.0 and so on", ["MIT", "CC-BY-4.0"]),
        ("This project is licensed under the MIT License - see the LICENSE file for details.", ["MIT"]),
        (APACHE, ["Apache-2.0"]),
        (MIT, ["MIT"]),
        (MPL, ["MPL-2.0"]),
        ("word " * 5000 + "released under the ISC License " + "word " * 5000, ["ISC"]),
        ("Licensed under CC BY 4.0.\n" * 300, ["CC-BY-4.0"] * 300),
        ("Licensed under the Apache License, Version 1.1.", []),
        ("Licensed under the Apache License, Version 2.0.1.", []),
        ("Released under the MIT License, version 2.", []),
        ("Licensed under CC BY-NC 3.0. Licensed under CC BY-XX 4.0.", []),
        (license_scan.TEMPLATES["GPL-3.0"][1].replace("General", "Lesser General"), []),
        (license_scan.TEMPLATES["GPL-3.0"][1].replace("version 3", "version 4"), []),
        (license_scan.TEMPLATES["ISC"][1].replace("software", "program"), ["ISC"]),
        ("The licence plate of the car was new. No copyright here.", []),
        ("Licensed under the BSD License.", []),
    ],
)
def test_real_notices(spark, text, expected):
    got = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    confirmed = [r.license for r in sorted(got, key=lambda r: r.start) if r.confirmed]
    assert confirmed == expected, [(r.license, r.block[:80], r.missing, r.extra) for r in got]
    assert all(r.block == text[r.start : r.stop].rstrip("\n") for r in got)
    spans = sorted((r.start, r.stop) for r in got)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_winners_of_the_small_table_equal_brute_force(spark):
    """Confirmed licences of each document are those whose words stand in it in a row; the savings are zstandard's."""
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    exact = set()
    for doc, text in docs:
        own = " " + " ".join(re.findall(r"\w+(?:[.-]\w+)*", text.lower())) + " "
        for name, wordings in license_scan.TEMPLATES.items():
            if any(" " + " ".join(re.findall(r"\w+(?:[.-]\w+)*", w.lower())) + " " in own for w in wordings):
                exact.add((doc, name))
    got = license_scan.scan(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert exact and {(r.doc_id, r.license) for r in got if r.confirmed} == exact

    options = dict(level=9, write_content_size=False, write_checksum=False, write_dict_id=False)
    for block in {r.block.strip(): r for r in got if not r.confirmed}.values():
        data = " ".join(block.block.lower().split()).encode()
        sizes = {}
        for name, wordings in license_scan.TEMPLATES.items():
            for wording in wordings:
                raw = zstandard.ZstdCompressionDict(wording.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                size = len(zstandard.ZstdCompressor(dict_data=raw, **options).compress(data))
                sizes[name] = min(size, sizes.get(name, size))
        assert block.template_bytes == sizes[block.license] == min(sizes.values())
        assert block.plain_bytes == len(zstandard.ZstdCompressor(**options).compress(data))


def test_places_that_fit_equal_plain_dynamic_programming():
    template, block = "a b c d e f g h".split(), "x a b c q d e g h y a b c d e f g h".split()
    got = list(license_scan.fits(template, block, 2))
    assert got[0] == (10, 18, [], []) and (1, 9, ["f"], ["q"]) in got
    assert not list(license_scan.fits(template, ["z"], 2)) and not list(license_scan.fits(template, [], 2))
