"""Alignment of tokenizers, spelling variants and secret scans: brute force on the small table, and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from conftest import SF
from llm import brute
from tallybook.llm import queries as registered
from tallybook.llm import secrets, spelling, token_align

SCHEMA = "doc_id long, text string, word string, n int, row int, pairs string, spans string"
ODD = [
    (None, None), (1, None), (2, ""), (3, "  "), (4, "one two"), (4, "one two"), (5, "x▁y lost"), (6, "a\tb \n\n c  d"),
    (7, "<|endoftext|> <s> </s> <0x41>"), (8, "日本 語 😀😀 ñandú"), (None, "No id: password = abc123456 AKIA" + "Q" * 16), (9, "word " * 30_000), (10, "y" * 40_000),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, repeated rows, very long texts, signs of the tokenizers, and columns named like the operators' own."""
    return spark.createDataFrame([(*r, "w", 1, 2, "p", "s") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b, token_align.ByteBpe(public_tokenizers.path("byte_bpe_50k.json")).bytes, token_align.Pieces(public_tokenizers.path("piece_bpe_32k.model")).bytes


def alignment(text, tokenizers):
    """Whole texts through both tokenizers: ids of A and B, groups as text, links."""
    a, b, a_bytes, b_bytes = tokenizers
    raw = (" " + (text or "")).encode()
    one, two = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
    if b"".join(a_bytes[i] for i in one) != raw or b"".join(b_bytes[i] for i in two) != raw:
        return [], [], [], []
    ends = [np.cumsum([len(held[i]) for i in ids]).tolist() for ids, held in ((one, a_bytes), (two, b_bytes))]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(map(str, one[i:k])) + "|" + ",".join(map(str, two[j:m])))
        i, j = k, m
    span = [list(zip([0, *e[:-1]], e, strict=True)) for e in ends]
    links, first = [], 0
    for x, (s, e) in zip(one, span[0], strict=True):
        while first < len(two) and span[1][first][1] <= s:
            first += 1
        k = first
        while k < len(two) and span[1][k][0] < e:
            links.append((x, two[k]))
            k += 1
    return one, two, groups, links


def align_all(docs, tokenizers):
    found = [(d, *alignment(t, tokenizers)) for d, t in docs]
    held = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    digest = lambda groups: hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
    return sorted(
        (str(d), len(a), len(b), len(g), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), digest(g))
        for d, a, b, g, links in found
    )


def aligned_rows(frame):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect())


def small(spark, folder=SF):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())


def test_op11_equals_brute_force(spark, tokenizers):
    assert aligned_rows(registered.op11_token_align(spark, SF)) == align_all(small(spark), tokenizers)


def test_alignment_edge_cases(spark, odd, empty, tokenizers, monkeypatch):
    want = align_all(ODD, tokenizers)
    assert aligned_rows(token_align.scored(odd)) == want
    assert [r[1:] for r in want if r[0] in "1235"] == [(0,) * 6 + ("",)] * 2 + [r[1:] for r in want if r[0] == "3"] + [(0,) * 6 + ("",)]
    assert token_align.scored(empty).count() == 0
    monkeypatch.setattr(token_align, "SPREAD_PAIRS", 0)  # the join by a shuffle
    assert aligned_rows(token_align.scored(odd)) == want
    shown = {r.doc_id: r.groups for r in token_align.scored(odd, text=True).collect()}
    assert shown[6] == ";".join(alignment(ODD[7][1], tokenizers)[2]) and shown[2] == ""


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeéß 's.,\n\t12-_<>|日😀▁ \x1c"), max_size=30), max_size=5))
def test_alignment_by_parts_equals_whole_texts(tokenizers, texts):
    memory = token_align.Memory(token_align.ByteBpe(public_tokenizers.path("byte_bpe_50k.json")), PIECES, room=300)
    for _ in range(2):
        sizes, groups, _ = memory.align(texts)
        for text, size, group in zip(texts, sizes.tolist(), groups, strict=True):
            a, b, cut, _ = alignment(text, tokenizers)
            assert (size, group) == ([len(a), len(b), len(cut)], ";".join(cut))


PIECES = token_align.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def words_by_hand(docs, least=7, times=2):
    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= times}


def variants_by_hand(n, ratio=10):
    near, masks = defaultdict(set), defaultdict(set)
    for word in n:
        for k in range(len(word)):
            masks[word[:k], word[k + 1 :]].add(word)
            shorter = word[:k] + word[k + 1 :]
            if shorter in n:
                near[word].add(shorter)
                near[shorter].add(word)
    for own in masks.values():
        for word in own:
            near[word] |= own - {word}
    form = {}
    for word in n:
        best = min(near[word], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= ratio * n[word]:
            form[word] = best
    out = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n[word], len(near[word]), n[form[word]] if word in form else None))
    return sorted(out)


def variant_rows(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def test_op12_equals_brute_force(spark):
    assert variant_rows(registered.op12_spelling(spark, SF)) == variants_by_hand(words_by_hand(small(spark)))


@pytest.mark.parametrize("cell", [20, 5000])
def test_variants_of_made_up_words(spark, cell):
    """Chains of forms, ties, anagrams, long words, letters beyond one byte, in many small cells and in one."""
    rng = random.Random(3)
    n = {"grundform": 50_000, "grundfor": 900, "grunfor": 60, "grunforx": 5, "abcdefgh": 7, "abcdefgx": 7, "abcdefg": 70, "abcdefh": 70}
    n |= {"".join(rng.sample("aabbccd", 7)): rng.choice([1, 30, 500]) for _ in range(300)}
    for base in ("q" * 300, "日本語文字列表", "ñandúñandú"):
        n |= {base: 1000, base[:3] + "z" + base[4:]: 3, base[1:]: 40}
    n |= {chr(0x4E00 + i) * 7: 2 for i in range(300)}
    frame = spark.createDataFrame([(w, k, "x") for w, k in n.items()], "word string, n int, form string").repartition(3)
    got = variant_rows(spelling.variants(frame, cell=cell))
    assert got == variants_by_hand(n) and ("grunforx", "grunfor", "grundform") in {r[:3] for r in got}


def test_spelling_edge_cases(spark, odd, empty):
    assert {r.word: r.n for r in spelling.word_counts(odd, least=3).collect()} == words_by_hand([("" if d is None else d, t) for d, t in ODD], 3)
    assert spelling.variants(spelling.word_counts(empty)).count() == 0
    assert spelling.word_counts(odd, drop=None, least=40_000, times=1).collect()[0].word == "y" * 40_000


def secrets_by_hand(text):
    """The patterns, written out anew: rows (start, kind, end)."""
    text, found = text or "", []
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(map(either, ["password", "passwd", "secret", "token", "api_key", "apikey"]))
    for m in re.finditer(f"({names})[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def joined(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{e}" for a, k, e in spans)


def test_op13_equals_brute_force(spark):
    folder = SF.replace("sf0.001", "sf0.01")  # the smallest table has none
    got = {r.doc_id: r for r in registered.op13_secrets(spark, folder).collect()}
    docs = small(spark, folder)
    assert set(got) == {d for d, _ in docs} and any(r.n_assign for r in got.values())
    for doc, text in docs:
        want = secrets_by_hand(text)
        counts = Counter(k for _, k, _ in want)
        r = got[doc]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[k] for k in range(3))
        assert r.base_sha256 == brute.sha(joined(want)) and set(joined(want).split(",")) <= set(r.spans.split(","))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["token", "TOKEN", "ſecret", "secret", "api_key", "apiKey", "=", ":", " ", '"', "abc", "a1b2c3d4e5f6", "AKIA", "QWERTYUIOPASDFGH", "é", "-"]), max_size=14))
def test_patterns_by_hand(parts):
    text = "".join(parts)
    assert [(a, secrets.KINDS.index(k), e) for k, a, e, _ in secrets.matches(text)] == secrets_by_hand(text)


def test_automata_learn_a_format(spark):
    """Bare credentials of labelled formats are found; ordinary words, card numbers and addresses aren't."""
    rng = random.Random(7)
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    digits, hexa, upper = "0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    words = ["".join(rng.choice(["ent", "ing", "heit", "cion", "eau", "th"]) for _ in range(5)) for _ in range(800)]
    docs = [(i, f"x password={text(hexa, 18)} y AKIA{text(upper, 16)} z {words[i]} 4{text(digits, 15)} mail{i % 9}.example.com") for i in range(500)]
    planted = [(1000 + i, f"see {text(hexa, 20)} there") for i in range(50)]
    frame = spark.createDataFrame(docs + planted, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end, s.added) for s in r.spans] for r in secrets.scan(frame).collect()}
    assert sum((4, 24, True) in got[d] for d, _ in planted) >= 40
    assert sum(s[2] for d, _ in docs for s in got[d]) <= 10
    model = secrets.infer([d[1].split()[3] for d in docs])
    assert model.score("AKIA" + text(upper, 16)) > model.score(text(upper, 20)) + 20


def test_secret_edge_cases(spark, odd, empty):
    got = secrets.scan(odd).collect()
    assert Counter((r.doc_id, joined([(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.spans])) for r in got) == Counter(
        (d, joined(secrets_by_hand(t))) for d, t in ODD
    )
    assert secrets.scan(empty).count() == 0
