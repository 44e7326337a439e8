"""The registered queries over whole small tables, against brute force."""

from __future__ import annotations

import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check_oracle
from conftest import SF
from llm import brute
from tallybook.llm import license_scan, suffix_dedup
from tallybook.llm import queries as registered


def table(columns, name):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{SF}/{name}.parquet' ORDER BY 1").fetchall()


def rows(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SF).collect()]


@pytest.fixture(scope="module")
def docs():
    return table("doc_id, text", "documents")


def test_all_are_registered():
    names = entry.queries()
    assert [n.split("_")[0] for n in registered.queries()] == [f"op{i}" for i in range(1, 14)]
    assert set(registered.queries()) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", list(registered.oracle_sql()))
def test_equals_sql(spark, duck, name):
    assert check_oracle.compare(spark, duck, name, SF).startswith("ok")


def test_op1_finds_the_notices(spark, docs):
    got = rows(spark, "op1_license_scan")
    found = {(r["doc_id"], r["license"]) for r in got if r["confirmed"]}
    for license, wording in (("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0.")):
        assert license in license_scan.TEMPLATES
        assert {d for d, t in docs if wording in t} == {d for d, name in found if name == license}


def test_op2_scores_every_document(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op2_toxicity")}
    assert set(got) == {d for d, _ in docs}
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)


def test_op3_packs_every_id_once(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert brute.check_packing(docs, rows(spark, "op3_packing"), tokenizer) < 0.02


def test_op4_counts(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op4_quality_rules")}
    for d, text in docs:
        r = got[d]
        counts = brute.quality_counts(text)
        assert counts == tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r["base_failed"] and r["kept"])


def test_op4_keeps_good_documents(spark):
    good = {d for d, q in table("doc_id, quality", "labels") if q == 1}
    lost = [r["doc_id"] for r in rows(spark, "op4_quality_rules") if r["doc_id"] in good and not r["kept"] and not r["base_failed"]]
    assert len(lost) <= 0.02 * len(good)


def test_op5_comes_near_the_targets(spark):
    got = rows(spark, "op5_mixing")
    assert got and sorted(map(str, got)) == sorted(map(str, rows(spark, "op5_mixing")))
    targets = brute.mixing_targets(table("doc_id, text, source", "documents"))
    taken = Counter()
    for r in got:
        size, target = targets[r["source"]]
        assert r["source_size"] == size and abs(r["target"] - target) < 1e-6 * max(1, target)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.03 * t for s, (_, t) in targets.items())


def test_op7_recall(spark):
    near = brute.nearest(table("vec_id, embedding", "embeddings"))
    got = {}
    for r in sorted(rows(spark, "op7_hash_forest"), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(near)
    hits = sum(len({i for i, _ in near[q]} & {i for i, _ in got[q]}) for q in near)
    assert hits >= 0.9 * sum(map(len, near.values()))
    for q, own in got.items():
        exact = dict(brute.nearest(table("vec_id, embedding", "embeddings"), k=10**9)[q]) if q == min(got) else None
        assert exact is None or all(abs(exact[i] - s) < 1e-12 for i, s in own)


def test_op9_equals_brute_force(spark, docs):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(spark, "op9_suffix_dedup")}
    want = brute.suffix_dedup(docs)
    assert got == want
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    other = suffix_dedup.cleaned(frame, many=0)  # every anchor string by string
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes))) for r in other.collect()} == want


def test_op9_tells_passages_of_over_fifty_words(spark, docs):
    want = brute.shared_passages([text for _, text in docs], 51)
    assert {r["doc_id"]: r["repeats"] for r in rows(spark, "op9_suffix_dedup")} == {doc: int(w) for (doc, _), w in zip(docs, want)}
    assert 0 < sum(want) < len(want)


def test_op10_equals_brute_force(spark, docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op10_simhash")}
    assert got == brute.simhash_groups(docs)


def test_pipeline_equals_its_stages_by_brute_force(spark, docs):
    """Each stage on what its predecessor kept."""
    import corpus_pipeline

    frame = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    one = stage["quality_rules"](spark, frame, SF)
    assert one.columns == frame.columns
    kept = {r["doc_id"] for r in rows(spark, "op4_quality_rules") if r["kept"]}
    assert {r.doc_id for r in one.select("doc_id").collect()} == kept

    left = [(d, t) for d, t in docs if d in kept]
    two = stage["line_dedup"](spark, spark.createDataFrame(one.collect(), frame.schema), SF)
    texts = {r.doc_id: r.text for r in two.collect()}
    assert {d: brute.sha(t) for d, t in texts.items()} == {d: v[2] for d, v in brute.line_dedup(left).items()}
    assert all(r.n_chars == len(r.text) for r in two.collect())

    three = stage["simhash_near_dedup"](spark, spark.createDataFrame(two.collect(), frame.schema), SF)
    groups = brute.simhash_groups(sorted(texts.items()))
    stay = {d for d, (_, least) in groups.items() if d == least}
    assert sorted(r.doc_id for r in three.collect()) == sorted(stay)

    third = spark.createDataFrame(three.collect(), frame.schema)
    four = stage["mixing"](spark, third, SF).collect()
    times = Counter(r.doc_id for r in four)
    assert set(times) <= stay and max(times.values()) <= 2
    sizes = {d: len(brute.WORD.findall(t)) for d, t in texts.items()}
    total = sum(sizes[d] * n for d, n in times.items())
    assert abs(total - 1.5 * sum(sizes[d] for d in stay)) < 0.05 * total

    five = rows(spark, "pipeline")
    assert Counter(r["doc_id"] for r in five if r["start"] == 0) == times
