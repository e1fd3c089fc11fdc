"""The operators of this folder as queries over whole tables, with their check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitry.llm.bpe import bpe_digest
from visitry.llm.classifier import classify_quality
from visitry.llm.conversation_sql import REPAIR_SQL, TRIE_SQL
from visitry.llm.decontaminate import find_overlaps
from visitry.llm.katz import katz_scores
from visitry.llm.passages import repeated_passages
from visitry.llm.pii import extract_identifiers, span_digest
from visitry.llm.quality_rules import judge_quality
from visitry.llm.repair import damage, repair_digest
from visitry.llm.simhash import simhash_components
from visitry.llm.suffixes import remove_repeats
from visitry.llm.text import table
from visitry.llm.toxicity import score_toxicity
from visitry.llm.trie import conversation_trie
from visitry.llm.urls import host_of, judge_urls, path_of

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url; listed are the urls whose document number is labelled toxic."""
    pages = table(spark, folder, "pages")
    url = F.col("url")
    keys = pages.select(F.concat(host_of(url), path_of(url)).alias("key"), F.try_to_number(F.regexp_extract(path_of(url), r"/(\d{1,15})", 1), F.lit("999999999999999")).cast("long").alias("doc"))
    toxic = table(spark, folder, "labels").where("toxic = 1").select("doc_id").distinct()
    return judge_urls(pages, URL_RULES, keys.join(toxic, keys["doc"] == toxic["doc_id"], "left_semi").select("key").distinct())


OP1_SQL = r"""
WITH split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split),
listed AS (
  SELECT DISTINCT host || path AS key FROM split
  WHERE try_cast(regexp_extract(path, '/(\d{1,15})', 1) AS BIGINT) IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN host <> '' AND host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op2_compact_windows(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


def op3_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return find_overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


OP6_SQL = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
stretch AS (
  SELECT doc_id, k, md5_number(substring(x, 2 * k + 1, 400)) AS s
  FROM (SELECT doc_id, x, unnest(range(0, n - 199)) AS k FROM bytes)),
hit AS (SELECT doc_id, k FROM stretch WHERE s IN (SELECT s FROM stretch GROUP BY s HAVING count(*) > 1)),
marked AS (
  SELECT doc_id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 200 THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (
  SELECT doc_id, min(k) AS a, max(k) + 200 AS b
  FROM (SELECT doc_id, k, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS r FROM marked) GROUP BY doc_id, r),
gap AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM run
  UNION ALL SELECT doc_id, max(b), max(n) FROM run JOIN bytes USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substring(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b) AS y FROM gap JOIN bytes USING (doc_id) GROUP BY doc_id),
total AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)
"""


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op8_katz(spark: SparkSession, folder: str) -> DataFrame:
    return katz_scores(table(spark, folder, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digest(table(spark, folder, "documents"), vocabulary_path())


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return span_digest(extract_identifiers(table(spark, folder, "documents")))


def op11_clause_grammar(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_path_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return repair_digest(damage(table(spark, folder, "conversations")))


def op13_zfast_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


ALL = (
    op1_url_cascade, op2_compact_windows, op3_spaced_seeds, op4_quality_rules, op5_quality_classifier,
    op6_suffix_arrays, op7_simhash, op8_katz, op9_bpe, op10_pii, op11_clause_grammar,
    op12_path_ranking, op13_zfast_trie,
)
QUERIES = {f.__name__: f for f in ALL}
ORACLES = {"op1_url_cascade": OP1_SQL, "op6_suffix_arrays": OP6_SQL, "op12_path_ranking": REPAIR_SQL, "op13_zfast_trie": TRIE_SQL}
