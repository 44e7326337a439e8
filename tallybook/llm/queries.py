"""The registered queries, op1 to op13: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import hash_forest, license_scan, line_dedup, mixing, packing, quality_rules, secrets, simhash, spelling, suffix_dedup, token_align, toxicity, warc
from tallybook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).documents


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.cleaned(docs)
    return kept.select("doc_id", "line_counts.n_lines", "line_counts.n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.cleaned(table(spark, sf_dir, "documents"))
    digest, repeats = F.sha2("kept_bytes", 256).alias("kept_sha256"), F.col("shares").cast("int").alias("repeats")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", digest, repeats)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.scored(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: ~s["added"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = secrets.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2(secrets.listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *map(number, secrets.KINDS), digest, secrets.listed(spans).alias("spans"))


def queries() -> dict[str, Query]:
    return dict(sorted(((n, q) for n, q in globals().items() if n.startswith("op")), key=lambda nq: int(nq[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """The twins of op6 and op8. The tests hold the others, which SQL can't express, against brute force."""
    return {"op6_warc": OP6, "op8_line_dedup": OP8}


OP8 = """
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents
), k AS (
    SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
    ) AS key FROM l
), f AS (
    SELECT key AS frequent FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(frequent) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE frequent IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON key = frequent
GROUP BY doc_id
"""

OP6 = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
