"""Edge cases of the operators: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm import brute
from tallybook.llm import common, hash_forest, license_scan, line_dedup, mixing, packing, quality_rules, simhash, suffix_dedup, toxicity, warc

SCHEMA = "doc_id long, text string, source string, n_words int, key string, score double, print long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, repeated rows, a very long text, and columns named like the operators' own."""
    some = [
        (None, None, None), (1, None, "a"), (2, "", None), (3, " \t\n ", "a"), (4, "one", "b"), (4, "one", "b"),
        (5, "One", "b"), (6, LONG, "c"), (7, LONG, "c"), (None, "no id\nat all\n" * 3, "a"), (8, "ünï cödé " * 60, "b"), (9, "ünï cödé " * 60, "a"),
    ]
    return spark.createDataFrame([(*r, 0, "k", 0.5, 7) for r in some], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, None, None), (4, 0, 1), (None, 0, 1), (8, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")


def test_license_scan_edge_cases(spark, odd, empty):
    assert license_scan.scan(odd).count() == 0 and license_scan.scan(empty).count() == 0
    text = "Some words. Released under the MIT License.\nMore words.\n\nLicensed under CC BY 4.0. Licensed under CC BY 4.0.\nThe licence plate of a car."
    got = license_scan.scan(spark.createDataFrame([(None, text), (2, text)], "doc_id long, text string")).collect()
    own = sorted((r.start, r.license, r.confirmed, r.block) for r in got if r.doc_id == 2)
    assert own[0] == (11, "MIT", True, " Released under the MIT License.") and not own[-1][2]
    assert len(got) == 2 * len(own) and any(n == "CC-BY-4.0" for _, n, _, _ in own)


def test_license_versions_are_told_apart():
    scanner = license_scan.Scanner()
    for name, wordings in license_scan.TEMPLATES.items():
        for wording in wordings:
            assert scanner.judge(wording)[0] == name and scanner.judge(wording)[-1], wording
    other = scanner.judge("This work is licensed under the GNU General Public License, version 9.")
    assert not other[-1] and "9" in other[-2]


def test_toxicity_edge_cases(spark, odd, empty, labels):
    got = toxicity.judged(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.judged(empty, labels).count() == 0
    none = labels.limit(0)
    assert {r.predicted for r in toxicity.judged(odd, none).collect()} == {0}


def test_toxicity_held_out_and_misspelt():
    rng = np.random.default_rng(3)
    neutral = ["".join(rng.choice(list("aeioumnrst"), 6)) for _ in range(400)]
    texts, marks = [], []
    for i in range(500):
        own = list(rng.choice(neutral, 40))
        if i % 4 == 0:
            for at in rng.choice(40, 3, replace=False):
                own[at] = ["blockhead", "dimwit", "scoundrel"][int(rng.integers(3))]
        texts.append(" ".join(own))
        marks.append(int(i % 4 == 0))
    model = toxicity.fit(texts[:400], marks[:400])

    def score(text):
        words = toxicity.words_of(text)
        ids = np.array([hash(w) for w in words], np.int64)
        return model.score(np.where(toxicity.repeated(ids), 0, [model.word(w) for w in words]))

    right = sum((score(t) >= 0.5) == m for t, m in zip(texts[400:], marks[400:]))
    assert right >= 97
    clean = list(rng.choice(neutral, 40))
    assert score(" ".join(clean)) < 0.5
    assert score(" ".join([*clean, "Blockheadd", "scoundrell", "dimwitt!"])) >= 0.5


def test_packing_edge_cases(spark, odd, empty):
    got = packing.packed(odd).collect()
    assert packing.packed(empty).count() == 0
    assert sum(r.start == 0 for r in got) == odd.count()
    assert [r.doc_tokens for r in got if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert max(r.length for r in got) == 2048
    ids = packing.packed(odd, ids=True).collect()
    assert all(len(r.ids) == r.length for r in ids)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=12))
def test_pack_histogram(counts):
    patterns = packing.pack_histogram(counts, 64)
    held = {}
    for p in patterns:
        assert sum(p.lengths) <= 64 and p.count > 0
        for length in p.lengths:
            held[length] = held.get(length, 0) + p.count
    assert held == counts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_word_tokens_equal_the_tokenizer(texts):
    tokens = TOKENS
    for text in [*texts, "İstanbul ΑΣ it's <|endoftext|>x é a\x1cb \x85c"]:
        want = np.array(tokens.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert tokens.ids(text) == want


TOKENS = packing.WordTokens(packing.public_tokenizers.path("word_bpe_49k.json"), room=50)


@pytest.mark.parametrize("text", ["Aİ.", "xİ, y***", "a-b... c$$$ d!!", "it's' x'.", "é.,;", "a<|endoftext|>. <| |>", "e\u0301! \u0338= a\u0338=", "...a.", "Ⅷ. ª, 中文!"])
def test_words_with_marks_equal_the_tokenizer(text):
    want = np.array(TOKENS.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert TOKENS.ids(text) == want


def test_marks_and_known_words_leave_the_tokenizer_alone(monkeypatch):
    """The whole tokenizer is asked for each distinct run of marks once, and known words next to new ones for nothing."""
    tokens = packing.WordTokens(packing.public_tokenizers.path("word_bpe_49k.json"))
    asked = []
    for name in ("_whole", "_word"):
        monkeypatch.setattr(tokens, name, lambda word, own=getattr(tokens, name): (asked.append(word), own(word))[1])
    tokens.known.find, tokens.tails.find = tokens._word, tokens._whole
    words = [f"{a}{b}***" for a in "abcdefghij" for b in "klmnopqrst"]
    tokens.ids(" ".join(words))
    assert len(asked) == 101 and asked.count("***") == 1
    tokens.ids(" ".join([*words, "new"]))
    assert asked[101:] == ["new"]


def test_ranks_do_not_depend_on_groups(spark):
    rows = [(i, 0, 5 if i % 3 else 2048, i * 7, 5) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    for each in (1000, 10):
        got = packing.ranked(frame, each).collect()
        for length in (5, 2048):
            ranks = sorted(r["rank"] for r in got if r.length == length)
            assert ranks == list(range(len(ranks)))


def test_quality_edge_cases(spark, odd, empty, labels):
    got = quality_rules.judged(odd, labels).collect()
    assert len(got) == odd.count()
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 4))
    assert quality_rules.judged(empty, labels).count() == 0
    for r in quality_rules.judged(odd, labels.limit(0)).collect():
        assert r.kept == (not r.base_failed)


@pytest.mark.parametrize("text", [
    "a b c d e f g h " * 4, "a " * 50, "x y z", "a b c d e f g h i a b c d e f g h j\na b c d e f g h i", "# $ ## <>|&\n\n \n# $ ## <>|&", LONG + " " + LONG[:500],
    "é\x0bü\x0cß\x1ca b \x00 \n\n é", "a\nb\na\nb\na\n \n ",
])
def test_quality_counts(spark, text):
    row = quality_rules.statistics(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert brute.quality_counts(text) == (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)


def test_quality_rules_are_learned(spark):
    rows = [(i, ("!! " if i % 3 else "") + f"{'WORD' if i % 5 == 0 else 'word'} " * 1 + " ".join(f"{'ABC' if i % 5 == 0 else 'abc'}{j}{i}" for j in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(0, 400, 2)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.judged(docs, marks).collect()}
    assert got == {i: i % 5 != 0 for i in range(400)}


def test_mixing_edge_cases(spark, odd, empty):
    mix = mixing.mixed(odd)
    got = mix.documents.collect()
    assert len(got) == odd.count() and mixing.mixed(empty).documents.count() == 0
    assert all(r.taken == 0 and r.copies == 0 for r in got if r["size"] == 0)
    targets = brute.mixing_targets([(r.doc_id, r.text, r.source) for r in odd.collect()])
    for r in got:
        assert abs(r.target - targets[r.source][1]) < 1e-6 and r.taken <= 2 * r["size"]
    ranks = {}
    for r in mix.schedule.orderBy("slot").collect():
        assert r["rank"] == ranks.get(r.place, 0)
        ranks[r.place] = r["rank"] + 1


@settings(max_examples=15, deadline=None)
@given(sizes=st.dictionaries(st.sampled_from(["a", "b", "c", "Z", "é", None]), st.integers(0, 5000), min_size=1))
def test_mixing_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = brute.mixing_targets([(0, "w " * n, s) for s, n in sizes.items()])
    assert all(abs(got[s] - want[s][1]) < 1e-6 for s in sizes)


def test_warc_edge_cases(spark, root):
    long = "<p>" + "x" * 200_000
    rows = [(3, "u", long), (1, None, long), (2, "a\r\nb c", None), (4, "", "short"), (5, "", "short"), (6, "u", "é" * 60), (6, "u", "é" * 60), (None, "u", long), (None, None, "ü" * 70), (7, "u", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    archive = warc.write(pages, f"file://{root}/a", shard_bytes=300_000, file_bytes=2000)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read(archive).collect()), key=str)
    want = sorted([
        (3, "revisit", 1, 200_003), (1, "response", None, 200_003), (2, "response", None, 0), (4, "response", None, 5), (5, "response", None, 5),
        (6, "response", None, 120), (6, "response", None, 120), (None, "revisit", 1, 200_003), (None, "response", None, 140), (7, "response", None, 240),
    ], key=str)
    assert got == want
    again = warc.write(pages.repartition(3), f"file://{root}/b", shard_bytes=300_000, file_bytes=2000)
    key = lambda a: sorted(tuple(r) for r in a.manifest.collect())
    assert key(archive) == key(again) and len(key(archive)) > 1
    assert warc.read(warc.write(pages.limit(0), f"file://{root}/c")).count() == 0


def test_warc_shards_follow_running_sums(spark):
    slim = spark.createDataFrame([(i, 1000) for i in range(100)], "page_id long, payload_bytes long")
    assert warc.shard_bounds(slim, 15_120) == list(range(10, 100, 10))
    assert len(warc.shard_bounds(slim, 1, most=4)) == 3


def test_forest_edge_cases(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(80)] + [(100, None), (101, [0.0, 0.0]), (102, [float("nan"), 1.0]), (103, [float("inf"), 1.0]), (104, [None, 1.0]), (105, [1.0]), (None, [1.0, 1.0]), (5, [2.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in hash_forest.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute.nearest(dict(rows[:80]).items())
    assert set(got) == {0, 20, 40, 60}
    for q, own in got.items():
        assert [(v, s) for _, v, s in sorted(own)] == want[q]
    few = hash_forest.nearest(frame.where("vec_id in (20, 21, 22)"), F.col("vec_id") == 20).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(few, key=lambda r: r["rank"])] in ([(1, 22), (2, 21)], [(1, 21), (2, 22)])
    assert hash_forest.nearest(frame.limit(0), F.col("vec_id") == 20).count() == 0


def test_forest_ascends_to_longer_vectors():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(600, 12)) * rng.uniform(0.1, 3, (600, 1))
    forest = hash_forest.Forest(rows)
    forest.fit(rows[:40], 10)
    hits = 0
    for query, (found, scores) in zip(rows[40:140], forest.search(rows[40:140], 10)):
        best = set(np.argsort(-(rows @ query))[:10].tolist())
        hits += len(best & set(found.tolist()))
        assert np.allclose(scores, rows[found] @ query)
    assert hits >= 900


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 20_000).astype(np.int64)
    held = line_dedup.CuckooFilter.of(keys[:10_000])
    assert held.contains(keys[:10_000]).all() and held.contains(keys[10_000:]).mean() < 0.01
    again = line_dedup.CuckooFilter.loaded(held.dumped())
    for key in keys[:5000].view(np.uint64):
        again.delete(int(key))
    assert again.contains(keys[5000:10_000]).all() and again.contains(keys[:5000]).mean() < 0.01
    with pytest.raises(KeyError):
        line_dedup.CuckooFilter.of(keys[:0]).delete(5)


def test_line_dedup_edge_cases(spark, odd, empty):
    got = line_dedup.cleaned(odd, least=2)
    assert got.columns == [*odd.columns, "line_counts"] and got.count() == odd.count()
    assert line_dedup.cleaned(empty).count() == 0
    texts = {(r.doc_id, r.line_counts.n_dropped) for r in got.collect()}
    assert {(6, 1), (7, 1), (4, 1), (5, 1), (1, 0), (2, 0)} <= texts  # 4 twice is one document; with 5 two hold "one"


def test_line_dedup_keeps_columns_named_like_its_own(spark):
    import corpus_pipeline

    rows = [(i, "same line\nline %d" % i, i, "x") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, line_counts int, Line_Counts_ string")
    got = line_dedup.cleaned(frame)
    assert got.columns == [*frame.columns, "line_counts__"]
    assert sorted((r.doc_id, r.text, r.line_counts, r.line_counts__.n_dropped) for r in got.collect()) == [(i, f"line {i}", i, 1) for i in range(12)]
    stage = dict(corpus_pipeline.STAGES)["line_dedup"](spark, frame, None)
    assert stage.columns == frame.columns and {(r.doc_id, r.text) for r in stage.collect()} == {(i, f"line {i}") for i in range(12)}


def test_mixing_of_shared_ids_ignores_the_order(spark):
    rows = [(7, f"w{i} " * 50, "ab"[i % 2]) for i in range(60)] + [(None, f"v{i} " * 50, "a") for i in range(20)]
    found = []
    for step in (1, -1, 7):
        order = rows[::step] if step != 7 else [rows[i * 7 % len(rows)] for i in range(len(rows) - 1)] + [rows[(len(rows) - 1) * 7 % len(rows)]]
        frame = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(abs(step))
        found.append(sorted((r.row_key, r.taken, r.copies) for r in mixing.mixed(frame).documents.collect()))
    assert found[0] == found[1] == found[2] and sum(x[1] for x in found[0])


def test_line_index_is_reversible(spark):
    base = [(i, "\n".join(f"line {j}" for j in range(i % 7))) for i in range(60)]
    more = [(100 + i, "line 5\nline 9\nnew") for i in range(12)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = line_dedup.LineIndex.of(frame(base), least=10, keys_each=2)
    grown = index.insert(frame(more))
    back = grown.delete(frame(more))
    counts = lambda x: sorted((bytes(r.key), r.n) for r in x.counts.select("key", "n").collect())
    assert counts(index) == counts(back) != counts(grown)
    for own, rows in ((index, base), (grown, base + more), (back, base)):
        found = line_dedup.pairs(frame(rows))
        got = {(r.doc_id, bytes(r.key)) for r in own.frequent(found).collect()}
        dropped = {d: n for d, (_, n, _) in brute.line_dedup(rows).items()}
        assert {d: sum(x == d for x, _ in got) for d, _ in rows} == dropped


def test_suffix_edge_cases(spark, odd, empty):
    got = suffix_dedup.cleaned(odd, length=20).collect()
    assert len(got) == odd.count() and suffix_dedup.cleaned(empty).count() == 0
    assert all(r.n_removed == r.n_bytes for r in got if r.doc_id in (6, 7, 8, 9))
    assert all(r.n_removed == 0 for r in got if r.doc_id in (1, 2, 3, 4, 5))


@pytest.mark.parametrize("many", [0, 20_000])
def test_suffix_dedup_equals_brute_force(spark, many):
    rng = np.random.default_rng(5)
    parts = ["".join(rng.choice(list("abcd "), n)) for n in (30, 40, 70, 25)]
    texts = ["".join(parts[k] if k < 4 else "".join(rng.choice(list("abé\x00\x01"), 15)) for k in rng.integers(0, 7, 6)) for _ in range(25)] + ["aaaa" * 30, "ab" * 60, ""]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes))) for r in suffix_dedup.cleaned(frame, length=24, shard=500, many=many).collect()}
    assert got == brute.suffix_dedup(rows, 24)


def test_short_passages_of_many_words_are_told(spark):
    """51 words of under 400 bytes in two texts, whatever white space parts them; the same words twice in one text only."""
    passage, own = [f"w{i}x" for i in range(51)], [f"v{i}y" for i in range(51)]
    texts = ["one " + " ".join(passage) + " two", "three\n" + "\n \t".join(passage) + " four", " ".join(passage[:50]), " ".join(own) + " " + " ".join(own), "", None]
    got = {r.doc_id: r for r in suffix_dedup.cleaned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(texts[0]) < 400 and [got[i].shares for i in range(6)] == [True, True, False, False, False, False]
    assert [got[i].n_removed for i in range(6)] == [0] * 6


def test_passages_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    parts = [list(rng.choice(list("abcdef"), n)) for n in (6, 9, 14, 30)]
    texts = [" ".join(str(w) for k in rng.integers(0, 9, 3) for w in (parts[k] if k < 4 else rng.choice(["g", "h", "ij", "k\u00e9"], 12))) for _ in range(60)] + ["", None, "a " * 40, "a " * 40]
    rows = [(i % 50 if i % 7 else None, text) for i, text in enumerate(texts)]  # ids that several rows share, or none
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute.shared_passages(texts, 13)
    got = suffix_dedup.cleaned(frame, words=13, length=24).collect()
    assert True in want and False in want
    seen = [(r.doc_id, (r.n_bytes, r.shares)) for r in got]
    assert sorted(seen, key=str) == sorted(((i, (len((t or "").encode()), w)) for (i, t), w in zip(rows, want)), key=str)


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 16])
def test_words_are_hashed_alike_wherever_they_stand(monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    texts = [b"", b" \n", b"ab", b"  ab cde\tab\x0b", "caf\u00e9 ab abc cde".encode(), b"c a\x00 a " + b"long" * 9]
    names: dict[int, bytes] = {}
    for text, hashes in zip(texts, suffix_dedup.word_hashes(texts)):
        found, words = np.frombuffer(hashes, np.uint64).tolist(), re.findall(rb"[^ \t-\r]+", text)
        assert len(found) == len(words) and all(names.setdefault(h, w) == w for h, w in zip(found, words))
    assert len(names) == len(set(names.values())) == 8


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.integers(1, 9))
def test_suffix_array(numbers, length):
    text = np.array([*numbers, 0], np.uint16)
    whole = list(text)
    order = suffix_dedup.suffix_array(text)
    assert list(order) == sorted(range(len(whole)), key=lambda i: whole[i:])
    strings = [tuple(whole[i : i + length]) for i in range(len(whole) - length + 1)]
    want = [i < len(strings) and strings.count(strings[i]) > 1 for i in range(len(whole))]
    assert list(suffix_dedup.repeated(text, length)) == want


def test_regions_of_long_texts_do_not_depend_on_parts(monkeypatch):
    text = LONG[:50_000].encode()
    for part in (1 << 20, 7000):
        monkeypatch.setattr(suffix_dedup, "PART", part)
        found = list(suffix_dedup.regions([b"", text, b"short", text[:400]]))
        assert sum(stop - start - 399 for row, start, stop, _, _ in found if row == 1) == len(text) - 399
        assert [(a, b) for row, a, b, _, _ in found if row == 3] == [(0, 400)]


def test_simhash_edge_cases(spark, odd, empty):
    got = simhash.groups(odd).collect()
    assert len(got) == odd.count() and simhash.groups(empty).count() == 0
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1} and by_id[1].print == 0
    assert by_id[5].component_id == 4 and by_id[7].component_id == 6


@pytest.mark.parametrize("large", [8192, 3])
def test_near_prints_lose_no_pair(spark, large):
    rng = np.random.default_rng(2)
    prints = set()
    for base in rng.integers(0, 2**62, 12):
        for _ in range(12):
            flips = rng.choice(64, int(rng.integers(0, 4)), replace=False)
            prints.add(int(np.uint64(base) ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))) if len(flips) else int(base))
    prints = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    want = brute.roots(len(prints), zip(*np.nonzero(near)))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    edges = simhash.near_prints(frame, 2, large).collect()
    at = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    assert all(near[at[e.a], at[e.b]] or want[at[e.a]] == want[at[e.b]] for e in edges)
    got = brute.roots(len(prints), [(at[e.a], at[e.b]) for e in edges])
    same = lambda roots: {tuple(i for i, x in enumerate(roots) if x == r) for r in roots}
    assert same(got) == same(want)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=12), st.integers(0, 5), st.integers(0, 63))
def test_bit_sliced_links(numbers, radius, bit):
    prints = np.array([*numbers, *(n ^ (1 << bit) for n in numbers)], np.uint64)
    a, b = simhash.links(prints.view(np.int64), np.zeros(len(prints), np.int64), radius)
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (200, 200), (7, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in common.components(frame).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_pipeline_stages_on_odd_rows(spark, odd, empty):
    import corpus_pipeline
    from conftest import SF

    for frame in (odd, empty):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            docs = spark.createDataFrame(rows, out.schema)
    near = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, odd, SF)
    assert sorted((r.doc_id for r in near.collect()), key=str) == [1, 4, 6, 8, None]
    good = " ".join(f"word{i}" for i in range(30))
    mixed = spark.createDataFrame([(None, good), (None, "too short"), (2, good), (2, "short"), (5, good), (5, good)], "doc_id long, text string")
    kept = corpus_pipeline.quality(spark, mixed, SF)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, good), (5, good), (5, good), (None, good)], key=str)
    twice = corpus_pipeline.mix(spark, kept.withColumn("source", F.lit("a")), SF).collect()
    assert 4 <= len(twice) <= 8 and {len(r) for r in twice} == {3}
    none = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "e f g h"), (3, "i j k"), (3, "l m n o p")], "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, none, SF).collect()
    assert sorted(r.text for r in kept if r.doc_id is None) == ["a b c d", "e f g h"]
    assert sum(r.doc_id == 3 for r in kept) == 1  # rows that share an id are one document
