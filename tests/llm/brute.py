"""Plain Python versions of the queries' contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def line_dedup(docs, least=10):
    """{doc_id: (n_lines, n_dropped, kept_sha256)}"""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower()
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or len(holders[key(x)]) < least]
        out[doc] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def simhash(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, shingle=3, radius=2):
    """{doc_id: (fingerprint, component_id)}"""
    prints = [simhash(text, shingle) for _, text in docs]
    array = np.array(prints, np.uint64)
    pairs = []
    for i in range(len(array)):
        near = np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= radius)
        pairs += [(i, i + 1 + j) for j in near]
    root = roots(len(docs), pairs)
    least = {}
    for (doc, _), r in zip(docs, root):
        least[r] = min(doc, least.get(r, doc))
    return {doc: (f"{p:016x}", least[r]) for (doc, _), p, r in zip(docs, prints, root)}


def check_packing(docs, rows, tokenizer, size=2048):
    """Holds the packed pieces against the contract; gives the share of padding."""
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(own) == {doc for doc, _ in docs}
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(own[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    filled = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        filled += at
    return 1 - filled / (size * len(sequences)) if sequences else 0.0


def mixing_targets(docs, weights=(3, 1, 2), share=1.5, limit=2):
    """docs: (doc_id, text, source). {source: (size, target)}"""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total, out = set(order), share * sum(sizes.values()), {}
    while left:
        level = total / sum(weight[s] for s in left)
        stopped = {s for s in left if level * weight[s] > limit * sizes[s]}
        if not stopped:
            out |= {s: (sizes[s], level * weight[s]) for s in left}
            break
        for s in stopped:
            out[s] = (sizes[s], float(limit * sizes[s]))
            total -= limit * sizes[s]
        left -= stopped
    return out


def nearest(rows, k=20, every=20):
    """rows: (vec_id, vector). {query_id: [(vec_id, score), ...]}"""
    rows = [(i, np.asarray(v, np.float64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in rows:
        if q % every == 0:
            near = sorted(((-float((x * y).sum()), i) for i, y in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def suffix_dedup(docs, length=400):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    texts = [(doc, (text or "").encode()) for doc, text in docs]
    count = Counter(xxhash.xxh3_128_digest(t[i : i + length]) for _, t in texts for i in range(len(t) - length + 1))
    out = {}
    for doc, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[xxhash.xxh3_128_digest(t[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int(np.sum(np.diff(np.r_[0, gone.astype(np.int8)]) == 1))
        out[doc] = (len(t), int(gone.sum()), spans, sha(kept))
    return out


def shared_passages(texts, words):
    """For each text, whether ``words`` of its words in a row stand in another one too."""
    runs = []
    for text in texts:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs.append({tuple(own[i : i + words]) for i in range(len(own) - words + 1)})
    count = Counter(run for own in runs for run in own)
    return [any(count[run] > 1 for run in own) for own in runs]
