"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scanloom.llm.common import table
from scanloom.llm.mixing import mix_to_weights
from scanloom.llm import collocations, jaccard, urls
from scanloom.llm.licenses import scan_licenses
from scanloom.llm.decontaminate import find_leaks
from scanloom.llm.lines import line_report
from scanloom.llm.omh import near_duplicates
from scanloom.llm.quality import quality_report
from scanloom.llm.runs import digests, find_runs
from scanloom.llm.secrets import scan_corpus
from scanloom.llm.toxicity import score_toxicity
from scanloom.llm.warc import archived_pages


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_corpus(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_to_weights(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def with_repeats(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: in documents whose id's checksum is divisible by 10, the words from a place on repeat the first p
    of them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_runs(table(spark, sf_dir, "documents"), edit=with_repeats))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_urls": op2_urls,
    "op3_order_minhash": op3_order_minhash,
    "op4_secrets": op4_secrets,
    "op5_licenses": op5_licenses,
    "op6_lines": op6_lines,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_decontaminate": op9_decontaminate,
    "op10_mixing": op10_mixing,
    "op11_runs": op11_runs,
    "op12_collocations": op12_collocations,
    "op13_jaccard": op13_jaccard,
}

ORACLES: dict[str, str] = {
    "op1_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
FROM f
""",
    "op2_urls": urls.oracle(),
    "op12_collocations": collocations.ORACLE,
    "op13_jaccard": jaccard.ORACLE,
    "op8_quality": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), c AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         len(string_split(t, chr(10))) AS n_lines, length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN lines USING (doc_id)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 2 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 2 * n_dup_lines > n_lines OR 2 * letters < word_chars) AS kept
FROM f
""",
}
